"""Queries that run as streams to their end."""

from __future__ import annotations

import uuid

from ..session import shared_path
from ..streaming import ingest
from .registry import Registry

R = Registry()


def _run(spark, df, mode):
    """The result of a stream run to its end, in the shared folder: executors write it, none of it comes to the driver."""
    to = shared_path(spark, f"stream_{uuid.uuid4().hex[:12]}")
    out = f"{to}/rows"
    # a stream without files has no batch
    spark.createDataFrame([], df.schema).write.parquet(out)

    def batch(rows, _):
        rows.write.mode("overwrite" if mode == "complete" else "append").parquet(out)

    q = df.writeStream.outputMode(mode).foreachBatch(batch).option("checkpointLocation", f"{to}/checkpoint").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(df.schema).parquet(out)


@R.add("st1_windowed_events", "SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n, round(sum(value), 6) AS total FROM events GROUP BY 1, 2")
def st1(spark, sf):
    return _run(spark, ingest.windowed(ingest.stream_of(spark, sf, "events.parquet")), "complete")


@R.add("st2_sessions", """
WITH e AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh FROM events),
s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM e)
SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 30 MINUTE AS "end", count(*) AS n FROM s GROUP BY user_id, k""")
def st2(spark, sf):
    return _run(spark, ingest.sessions(ingest.stream_of(spark, sf, "events.parquet")), "complete")
