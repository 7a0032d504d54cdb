"""Processing only new or changed records, by comparing Merkle trees over key ranges.

A state is a DataFrame (key string, token string), one row per key; the token stands for
everything whose change makes a record due again. Keys are spread by their SHA-256, whose
leading hex digits name the range (the leaf). A leaf's digest is the count and the XOR of
its rows' SHA-256, so it is built by partial aggregation and holds no list; a parent's
digest is the SHA-256 over its at most 256 children in order.

On disk a state is a sequence of versions. A version's marker names the folder of the attempt
that made it, in which its tree, its output and the rows of the key ranges that changed lie
together; the other ranges' rows stay where an earlier version wrote them.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..common import broadcast_checked, norm_hash
from ..session import materialise, remove, shared_path

#: Hex digits that name a leaf, where no state says otherwise.
LEAF = 4
#: Keys of a leaf, about, and of a file of rows when a state is first saved; versions that are kept.
LEAF_KEYS, FILE_KEYS, KEEP = 1024, 500_000, 2


def leaf_of(key: str, leaf: int = LEAF) -> Column:
    return F.substring(F.sha2(F.col(key), 256), 1, leaf)


def leaf_digits(keys: int) -> int:
    """The digits of a leaf's name for so many keys, from 2 to 12."""
    return min(12, max(2, math.ceil(math.log(max(1, keys / LEAF_KEYS), 16))))


def range_digits(keys: int) -> int:
    """The digits of a range, in which rows are stored: 16 ranges, from a file of rows for each on 256."""
    return 1 if keys < 16 * FILE_KEYS else 2


def widths(leaf: int) -> list[int]:
    return [*range(0, leaf, 2), leaf]


def one_row_per_key(state: DataFrame) -> DataFrame:
    """The state without null keys; of rows with equal keys the greatest token counts, null as ''."""
    return (
        state.select("key", F.coalesce("token", F.lit("")).alias("token"))
        .where(F.col("key").isNotNull())
        .groupBy("key")
        .agg(F.max("token").alias("token"))
    )


def leaves_of(state: DataFrame, leaf: int = LEAF) -> DataFrame:
    """(node, digest): the leaves over a state with one row per key."""
    h = F.sha2(F.concat_ws("\u001f", "key", "token"), 256)
    parts = [F.bit_xor(F.conv(F.substring("h", 1 + 15 * i, 15), 16, 10).cast("bigint")).alias(f"x{i}") for i in range(4)]
    x = state.select(leaf_of("key", leaf).alias("node"), h.alias("h")).groupBy("node").agg(F.count("*").alias("n"), *parts)
    return x.select("node", F.sha2(F.concat_ws("|", "n", *(f"x{i}" for i in range(4))), 256).alias("digest"))


def tree_over(leaves: DataFrame, leaf: int = LEAF) -> DataFrame:
    """(level int, node string, digest string) from the leaves up to the root."""
    out, below = leaves.select(F.lit(leaf).alias("level"), "node", "digest"), leaves
    for width in reversed(widths(leaf)[:-1]):
        below = (
            below.groupBy(F.substring("node", 1, width).alias("node"))
            .agg(F.sort_array(F.collect_list(F.concat_ws(":", "node", "digest"))).alias("children"))
            .select("node", F.sha2(F.concat_ws(",", "children"), 256).alias("digest"))
        )
        out = out.unionByName(below.select(F.lit(width).alias("level"), "node", "digest"))
    return out


def tree(state: DataFrame, leaf: int = LEAF) -> DataFrame:
    """tree_over() the leaves of a state with one row per key.

    An empty state has no nodes. Equal states give equal trees, in whatever order or
    partitioning their rows come.
    """
    return tree_over(leaves_of(state, leaf), leaf)


def changed_leaves(current: DataFrame, saved: DataFrame, leaf: int = LEAF) -> DataFrame:
    """(node): leaves whose digests differ between two trees of one depth, found by descending
    from the root only into nodes that differ."""
    differ = None
    for width in widths(leaf):
        a = current.where(F.col("level") == width).select("node", F.col("digest").alias("a"))
        b = saved.where(F.col("level") == width).select("node", F.col("digest").alias("b"))
        if differ is not None:
            # up to four digits there are no more than 65,536 parents
            few = F.broadcast(differ) if last <= 4 else differ
            parent = F.substring("node", 1, last)
            a = a.withColumn("parent", parent).join(few, "parent", "left_semi").drop("parent")
            b = b.withColumn("parent", parent).join(few, "parent", "left_semi").drop("parent")
        nodes = a.join(b, "node", "full_outer").where(~F.col("a").eqNullSafe(F.col("b"))).select("node")
        differ, last = nodes.withColumnRenamed("node", "parent"), width
    return nodes


def changes(current: DataFrame, saved: DataFrame, leaves: DataFrame, leaf: int = LEAF) -> DataFrame:
    """(key, token, change): of the leaves that differ the keys to process (new, changed) and
    those that went away (deleted)."""
    leaves = F.broadcast(leaves) if leaf <= 4 else leaves
    a = current.withColumn("node", leaf_of("key", leaf)).join(leaves, "node", "left_semi").select("key", "token")
    b = saved.withColumn("node", leaf_of("key", leaf)).join(leaves, "node", "left_semi").select("key", F.col("token").alias("was"))
    change = F.when(F.col("was").isNull(), "new").when(F.col("token").isNull(), "deleted").otherwise("changed")
    return a.join(b, "key", "full_outer").where(~F.col("token").eqNullSafe(F.col("was"))).select("key", "token", change.alias("change"))


# ---- the state on disk


class RunLost(RuntimeError):
    """Another run published the version that this one was about to publish."""


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _names(spark: SparkSession, folder: str) -> list[str]:
    fs, p = _fs(spark, folder)
    return [x.getPath().getName() for x in fs.listStatus(p)] if fs.exists(p) else []


def committed(spark: SparkSession, state_dir: str) -> int:
    """The last published version, 0 before the first."""
    return max([int(n[len("_committed-") :]) for n in _names(spark, state_dir) if n.startswith("_committed-")], default=0)


class State:
    """A published version: the depth of its tree and where the rows of each range lie."""

    def __init__(self, spark: SparkSession, state_dir: str, version: int) -> None:
        self.spark, self.dir, self.version = spark, state_dir, version
        self.leaf, self.digits, self.at, self.folder = None, None, {}, None
        if version:
            fs, p = _fs(spark, f"{state_dir}/_committed-{version}")
            stream = fs.open(p)
            said = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
            stream.close()
            self.leaf, self.digits, self.at, self.folder = said["leaf"], said["digits"], said["ranges"], said["folder"]

    def tree(self) -> DataFrame:
        if not self.version:
            return self.spark.createDataFrame([], "level int, node string, digest string")
        return self.spark.read.parquet(f"{self.dir}/{self.folder}/tree")

    def output(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{self.folder}/output")

    def rows(self, ranges: set[str] | None = None) -> DataFrame:
        """(key, token) of the ranges, of all without any named; only their files are read."""
        paths = [f"{self.dir}/{f}/rows/range={r}" for r, f in sorted(self.at.items()) if ranges is None or r in ranges]
        if not paths:
            return self.spark.createDataFrame([], "key string, token string")
        return self.spark.read.schema("key string, token string").parquet(*paths)


def _ranges(nodes: DataFrame, digits: int) -> set[str]:
    """The ranges of some leaves, at most 256."""
    return {r[0] for r in nodes.select(F.substring("node", 1, digits)).distinct().collect()}


def _publish(spark: SparkSession, state_dir: str, version: int, said: dict) -> None:
    """The marker of a version, by one rename that fails if there is one already."""
    jvm, folder = spark._jvm, said["folder"]
    draft = f"{state_dir}/{folder}/marker"
    fs, p = _fs(spark, draft)
    out = fs.create(p, True)
    out.write(bytearray(json.dumps(said).encode()))
    out.close()
    to = jvm.org.apache.hadoop.fs.Path(f"{state_dir}/_committed-{version}")
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri() if p.toUri().getScheme() else fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        context.rename(fs.makeQualified(p), fs.makeQualified(to), spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
    except Exception as e:
        if fs.exists(to):
            raise RunLost(f"version {version} of {state_dir} was published by another run") from e
        raise


def _vacuum(spark: SparkSession, state_dir: str, version: int) -> None:
    """Removes versions before the last KEEP, and the rows that only they refer to."""
    kept = [State(spark, state_dir, v) for v in range(max(1, version - KEEP + 1), version + 1)]
    used = {s.folder for s in kept} | {f for s in kept for f in s.at.values()}
    old = [int(n[len("_committed-") :]) for n in _names(spark, state_dir) if n.startswith("_committed-") and int(n[len("_committed-") :]) <= version - KEEP]
    for v in old:
        s = State(spark, state_dir, v)
        for f in {s.folder, *s.at.values()} - used:
            remove(f"{state_dir}/{f}", spark)
        remove(f"{state_dir}/_committed-{v}", spark)


def run_incremental(spark: SparkSession, current: DataFrame, state_dir: str, process: Callable[[DataFrame], DataFrame], partial: bool = False) -> tuple[int, DataFrame]:
    """Process what changed since the last published run; returns (version, its output).

    process gets (key, token, change) and returns the output. The saved tree is read and
    compared with the current one from the root down; rows are read back and written for those
    ranges alone that hold a changed leaf. With partial, current holds some keys only: they
    replace the saved ones, the rest stays unread. Output, tree and rows are written into a
    folder of this attempt's own, which becomes the next version by one atomic marker. A run
    that fails at any point leaves no marker, so the next one starts from the same saved tree
    and no record is skipped or repeated; of two runs at once the later one raises RunLost.
    With an empty current table all saved keys come out as deleted (none with partial).
    """
    saved = State(spark, state_dir, committed(spark, state_dir))
    attempt = f"v{saved.version + 1}-{uuid.uuid4().hex}"
    to = f"{state_dir}/{attempt}"
    now = materialise(one_row_per_key(current), "state")
    n = now.count()
    leaf, digits = saved.leaf or leaf_digits(n), saved.digits or range_digits(n)
    try:
        if partial and saved.version:
            touched = _ranges(now.select(leaf_of("key", leaf).alias("node")), digits)
            kept = saved.rows(touched).join(now.select("key"), "key", "left_anti")
            now = materialise(kept.unionByName(now), "merged")
            others = saved.tree().where((F.col("level") == leaf) & ~F.substring("node", 1, digits).isin(*touched)).select("node", "digest")
            leaves = leaves_of(now, leaf).unionByName(others)
        else:
            leaves = leaves_of(now, leaf)
        tree_over(leaves, leaf).write.parquet(f"{to}/tree")
        differ = materialise(changed_leaves(spark.read.parquet(f"{to}/tree"), saved.tree(), leaf), "changed_leaves")
        ranges = _ranges(differ, digits)
        process(changes(now, saved.rows(ranges), differ, leaf)).write.parquet(f"{to}/output")
        rows = now.withColumn("range", leaf_of("key", digits)).where(F.col("range").isin(*ranges))
        files = F.pmod(F.xxhash64("key"), F.lit(max(1, n // (16**digits * FILE_KEYS))))
        rows.repartition(F.col("range"), files).sortWithinPartitions("range", "key").write.partitionBy("range").parquet(f"{to}/rows")
        held = {n[len("range=") :] for n in _names(spark, f"{to}/rows") if n.startswith("range=")}
        at = {r: f for r, f in saved.at.items() if r not in ranges} | dict.fromkeys(sorted(held), attempt)
        _publish(spark, state_dir, saved.version + 1, {"folder": attempt, "leaf": leaf, "digits": digits, "ranges": at})
    except BaseException:
        remove(to, spark)
        raise
    _vacuum(spark, state_dir, saved.version + 1)
    return saved.version + 1, spark.read.parquet(f"{to}/output")


# ---- the importer's records


def digests_in_force(digests: DataFrame) -> DataFrame:
    """(key, digest): of each record the delivery with the latest produced_at among those with
    a digest; equal times go to the later arrival, then the greater digest."""
    return (
        digests.select(norm_hash("record_content_hash").alias("key"), norm_hash("digest_sha256").alias("digest"), "produced_at", "arrived_at")
        .where(F.col("key").isNotNull() & F.col("digest").isNotNull())
        .groupBy("key")
        .agg(F.max_by("digest", F.struct("produced_at", "arrived_at", "digest")).alias("digest"))
    )


def imported_state(receipts: DataFrame, runs: DataFrame) -> DataFrame:
    """(key, digest, generation): of each record the receipt of its latest run among succeeded runs."""
    done = broadcast_checked(runs.where(F.lower(F.trim("run_status")) == "succeeded").select("run_id").distinct())
    return (
        receipts.select(norm_hash("record_content_hash").alias("key"), norm_hash("digest_sha256").alias("digest"), F.col("import_generation").alias("generation"), "run_id")
        .where(F.col("key").isNotNull())
        .join(done, "run_id", "left_semi")
        .groupBy("key")
        .agg(F.max_by(F.struct("digest", "generation"), F.struct("run_id", "digest", "generation")).alias("s"))
        .select("key", "s.digest", "s.generation")
    )


def due_records(digests: DataFrame, receipts: DataFrame, runs: DataFrame, state_dir: str | None = None) -> DataFrame:
    """(key): records whose digest in force is new, or differs from what the last successful
    import left, or whose import generation isn't the current one.

    Both sides become states: the token is the digest and the generation, the wanted
    generation being that of the latest succeeded run. Without a succeeded run every record
    with a digest is due. A null generation never equals the wanted one.

    What the imports left is saved as the first version of the state (in state_dir, where the
    caller names a new one, else in the shared folder); the run against it reads that version's
    tree, descends, and publishes the due records together with the tree of what is wanted.
    """
    latest = runs.where(F.lower(F.trim("run_status")) == "succeeded").agg(F.max_by("import_generation", "run_id").alias("g")).first()
    wanted = "none" if latest is None or latest["g"] is None else str(latest["g"])
    now = digests_in_force(digests).select("key", F.concat_ws("|", "digest", F.lit(wanted)).alias("token"))
    was = imported_state(receipts, runs).select("key", F.concat_ws("|", F.coalesce("digest", F.lit("-")), F.coalesce(F.col("generation").cast("string"), F.lit("-"))).alias("token"))
    state_dir = state_dir or shared_path(digests.sparkSession, "import_state")
    spark = digests.sparkSession
    if not committed(spark, state_dir):
        run_incremental(spark, was, state_dir, lambda c: c.where(F.lit(False)))
    _, due = run_incremental(spark, now, state_dir, lambda c: c.where("change <> 'deleted'").select("key"))
    return due
