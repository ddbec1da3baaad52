"""Session helpers: a tuned session, the shared folder, lineage cuts, size checks."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Rows and bytes a side may have before it is no longer sent to every executor.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20
# Bytes of one range of a numbered or sorted layout.
RANGE_BYTES = 128 << 20
# Rows whose width is measured for a layout, and rows a range has at least where cores are free.
WIDTH_ROWS = 10_000
SPREAD_ROWS = 20_000


def session(app: str = "lodestone", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC time and adaptive execution, incl. skew-join splitting."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        **conf,
    }
    for k, v in settings.items():
        b = b.config(k, v)
    return b.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Where it is unset a local session (tests) gets a temporary folder; a cluster
    session is refused, because a machine-local folder would lose data there.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(named)
        return named
    if sc.getCheckpointDir() is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="lodestone-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Cut lineage through reliable storage, so lost executors cost no recompute."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _row_bytes(df: DataFrame) -> Column:
    """About how large a row is: text by its length, nested values by their JSON text."""
    size = F.lit(0).cast("bigint")
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(c), F.lit(0))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            size = size + F.coalesce(F.octet_length(F.to_json(c)), F.lit(0))
        else:
            size = size + 8
    return size


def range_count(df: DataFrame) -> int:
    """How many ranges of ``RANGE_BYTES`` a table fills: its rows by the mean width of its first 10,000.

    Ten times the rows make ten times the ranges, whatever ``spark.sql.shuffle.partitions`` says; smaller tables are spread over the
    session's cores.  Only the layout depends on it, never a result.  The rows are counted by a scan of the columns that the plan's
    filters read; cut a table first that is dear to compute.
    """
    rows = df.count()
    width = df.limit(WIDTH_ROWS).agg(F.avg(_row_bytes(df))).first()[0] or 8
    spread = min(df.sparkSession.sparkContext.defaultParallelism, -(-rows // SPREAD_ROWS))
    return max(1, spread, math.ceil(rows * width / RANGE_BYTES))


def is_small(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Whether ``df`` is within both bounds; reads no more than ``rows + 1`` rows."""
    seen = df.select(_row_bytes(df).alias("b")).limit(rows + 1).agg(F.count(F.lit(1)), F.sum("b")).first()
    return seen[0] <= rows and (seen[1] or 0) <= size


def small_side(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only when the side's rows and bytes have been checked."""
    return F.broadcast(df) if is_small(df, rows) else df
