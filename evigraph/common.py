"""Column expressions and join helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows up to which broadcast_checked broadcasts a side.
BROADCAST_ROWS = 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def norm_id(c: str | Column) -> Column:
    """An id trimmed and in lower case; a blank one is null."""
    x = F.lower(F.regexp_replace(col(c), r"^[\s ]+|[\s ]+$", ""))
    return F.when(x != "", x)


def norm_hash(c: str | Column) -> Column:
    """The 64 hex digits at the end, in lower case, whatever scheme stands before; else null."""
    x = F.regexp_extract(F.lower(col(c)), r"([0-9a-f]{64})\s*$", 1)
    return F.when(x != "", x)


def parse_utc(c: str | Column) -> Column:
    """A text timestamp as an instant; text without an offset is UTC, unreadable text is null.

    The offset is added to the text, so the result doesn't depend on the session's zone.
    """
    x = F.trim(col(c))
    zoned = x.rlike(r"(?i)(Z|UTC|[+-]\d{2}:?\d{2})$") & x.rlike(r"^\d{4}-\d{2}-\d{2}[ T]")
    dated = x.rlike(r"^\d{4}-\d{2}-\d{2}$")
    return F.when(zoned, x.try_cast("timestamp")).otherwise(
        F.when(dated, F.concat(x, F.lit("T00:00:00Z"))).otherwise(F.concat(x, F.lit("Z"))).try_cast("timestamp")
    )


def utc_month(c: str | Column) -> Column:
    """yyyy-MM in UTC of a text timestamp."""
    ts = parse_utc(c)
    # the epoch's days, so that the session's zone has no say
    return F.date_format(F.date_add(F.lit("1970-01-01").cast("date"), F.floor(F.unix_micros(ts) / F.lit(86_400_000_000)).cast("int")), "yyyy-MM")


def node_type(c: str | Column) -> Column:
    """A node type trimmed, in lower case and in the canonical spelling."""
    x = F.lower(F.trim(col(c)))
    # fixed values: spellings of the canonical types
    same = {"organization": "organisation", "org": "organisation", "people": "person", "persons": "person", "organisations": "organisation", "organizations": "organisation"}
    out = F.lit(None).cast("string")
    for k, v in same.items():
        out = F.coalesce(out, F.when(x == k, F.lit(v)))
    return F.coalesce(out, x)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether df has at most so many rows; counts no further than that."""
    return df.limit(rows + 1).count() <= rows


def broadcast_checked(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """df with a broadcast hint if its row count was checked to be small, else df itself."""
    return F.broadcast(df) if small(df, rows) else df


def salted_semi(left: DataFrame, keys: DataFrame, on: list[str], salt_of: Column, salts: int = 16) -> DataFrame:
    """left_semi on columns of which one value may hold a large share of left's rows.

    keys (distinct) is repeated for each salt, left's rows are spread over the salts by salt_of.
    """
    salted = keys.select(*on).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return (
        left.withColumn("_salt", F.pmod(F.xxhash64(salt_of), F.lit(salts)).cast("int"))
        .join(salted, [*on, "_salt"], "left_semi")
        .drop("_salt")
    )


def with_position(df: DataFrame, order: list[Column], name: str, start: int = 1) -> DataFrame:
    """df with the global row number by order (a total order), written to the shared folder.

    Range partitions are sorted side by side; each row's number is its place in the partition
    plus the sizes of the partitions before it. No single task sees all rows, and only one
    row per partition is broadcast.
    """
    from .session import materialise

    low = F.lit((1 << 33) - 1)
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_m", F.monotonically_increasing_id())
        .withColumns({"_pid": F.shiftright("_m", 33), "_at": F.col("_m").bitwiseAND(low)})
        .drop("_m")
    )
    placed = materialise(placed, "position")
    sizes = placed.groupBy("_pid").agg((F.max("_at") + 1).alias("n")).orderBy("_pid").collect()  # one row per partition
    offsets, total = [], 0
    for r in sizes:
        offsets.append((r["_pid"], total))
        total += r["n"]
    schema = T.StructType([T.StructField("_pid", T.LongType()), T.StructField("_offset", T.LongType())])
    at = F.broadcast(df.sparkSession.createDataFrame(offsets, schema))
    return placed.join(at, "_pid").withColumn(name, F.col("_offset") + F.col("_at") + F.lit(start)).drop("_pid", "_at", "_offset")


def spread(df: DataFrame, *cols: str) -> DataFrame:
    """df over all shuffle partitions, whatever its size: for rows that cost much each (Python)."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *cols)
