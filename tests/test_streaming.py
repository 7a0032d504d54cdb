from evigraph.operators.incremental import State, committed
from evigraph.streaming import ingest


def test_batches_are_processed_once(spark, tmp_path):
    src, state, ck = (str(tmp_path / x) for x in ("src", "state", "ck"))
    schema = "key string, token string"
    put = lambda rows, n: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(src)

    def run():
        s = spark.readStream.schema(schema).json(src)
        ingest.ingest(s, state, ck, lambda c: c).awaitTermination()
        v = committed(spark, state)
        return v, {(r.key, r.token, r.change) for r in State(spark, str(state), v).output().collect()}

    put([("a", "1"), ("b", "1")], 0)
    assert run() == (1, {("a", "1", "new"), ("b", "1", "new")})
    put([("b", "2"), ("c", "1")], 1)
    assert run() == (2, {("b", "2", "changed"), ("c", "1", "new")})
    assert run()[0] == 2
    put([("b", "2")], 2)
    assert run() == (3, set())


def test_windows(spark, small):
    from evigraph.plans import streams

    df = streams._run(spark, ingest.windowed(ingest.stream_of(spark, small, "events.parquet")), "complete")
    assert df.agg({"n": "sum"}).first()[0] == spark.read.parquet(f"{small}/events.parquet").count()


def test_results_stay_off_the_driver(spark, small):
    from evigraph.plans import streams

    df = streams.st2(spark, small)
    assert df.inputFiles() and df.agg({"n": "sum"}).first()[0] == spark.read.parquet(f"{small}/events.parquet").count()
