"""A keyed store on plain parquet: key buckets in folders, and a commit file for each version.

A write makes new folders for the buckets it touches and then one commit file, which names the folder of every bucket.  Readers see whole
versions only, and a failed job leaves folders that no commit names.  A commit file is moved to its name, and that fails where the
version exists already: of two writers that started from one version the later fails, with nothing changed.  A commit may carry a batch
id; a batch committed before is skipped, which makes replays harmless.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.utils import AnalysisException

from lodestone.functions.updates import FieldOp
from lodestone.operators import writes
from lodestone.session import cut
from lodestone.sources.tables import slice_of

COMMIT = (
    "version bigint, kind string, batch string, rows bigint, affected bigint, changes bigint, failed bigint, "
    "buckets int, layout array<string>, deltas array<string>, schema string"
)
# Buckets of a new store; a store keeps the number it was made with.  Choose it so that a bucket is about a gigabyte.
BUCKETS = 16


class ConcurrentWrite(RuntimeError):
    """Another writer has committed the version that this one was to make; read again and repeat."""


def _only_missing(e: AnalysisException) -> None:
    """A folder that does not exist yet is empty; any other fault must not pass for that."""
    if e.getCondition() != "PATH_NOT_FOUND":
        raise e


def _count(seen: Observation, name: str) -> int:
    """What was observed over rows that are all written; a plan that proves empty while it runs loses its observation."""
    try:
        return seen.get[name]
    except Py4JJavaError as e:
        if "AssertionError" not in e.java_exception.getClass().getName():
            raise
        return 0


class Folder:
    """Names, removal and exclusive creation of files below a path, in whatever file system it is."""

    def __init__(self, spark: SparkSession, path: str):
        self.hadoop = spark._jvm.org.apache.hadoop.fs
        self.gateway, self.conf = spark.sparkContext._gateway, spark._jsc.hadoopConfiguration()
        self.path = self.hadoop.Path(path)
        self.fs = self.path.getFileSystem(self.conf)

    def names(self) -> dict[str, float]:
        """Names with their time of change in seconds."""
        if not self.fs.exists(self.path):
            return {}
        return {f.getPath().getName(): f.getModificationTime() / 1000 for f in self.fs.listStatus(self.path)}

    def remove(self, name: str) -> None:
        self.fs.delete(self.hadoop.Path(self.path, name), True)

    def create(self, name: str, text: str) -> None:
        """Write a file whole, or fail with ``FileExistsError``."""
        draft, final = self.hadoop.Path(self.path, f".{uuid.uuid4().hex}"), self.hadoop.Path(self.path, name)
        out = self.fs.create(draft, False)
        out.write(bytearray(text.encode()))
        out.close()
        files = self.hadoop.FileContext.getFileContext(self.fs.makeQualified(final).toUri(), self.conf)
        try:
            files.rename(self.fs.makeQualified(draft), self.fs.makeQualified(final), self.gateway.new_array(getattr(self.hadoop, "Options$Rename"), 0))
        except Py4JJavaError as e:
            self.fs.delete(draft, False)
            if e.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
                raise FileExistsError(name) from None
            raise


class Store:
    """Documents in buckets of their key (``base``), and the changes of feed batches that are not folded in yet (``delta``)."""

    def __init__(self, spark: SparkSession, path: str, key: str, buckets: int = BUCKETS):
        self.spark, self.path, self.key, self.new_buckets = spark, path.rstrip("/"), key, buckets
        self._commits, self._data = Folder(spark, f"{self.path}/commits"), Folder(spark, f"{self.path}/data")

    # -- commits --------------------------------------------------------------------------

    def commits(self) -> DataFrame:
        """One row a version: ``rows`` it has written, ``affected`` by a selection, and of a batch ``changes`` and ``failed``."""
        return self._all().select("version", "kind", "batch", "rows", "affected", "changes", "failed")

    def _all(self) -> DataFrame:
        try:
            return self.spark.read.schema(COMMIT).json(f"{self.path}/commits")
        except AnalysisException as e:
            _only_missing(e)
            return self.spark.createDataFrame([], COMMIT)

    def version(self) -> int:
        """Latest committed version, -1 for an empty store."""
        return max((int(n.removesuffix(".json")) for n in self._commits.names() if n.endswith(".json") and not n.startswith(".")), default=-1)

    def has_batch(self, batch: str) -> bool:
        return not self._all().where(F.col("batch") == batch).isEmpty()

    def _latest(self) -> dict:
        v = self.version()
        if v < 0:
            return {"version": -1, "buckets": self.new_buckets, "layout": [None] * self.new_buckets, "deltas": [], "schema": None}
        return self.spark.read.schema(COMMIT).json(f"{self.path}/commits/{v:020d}.json").first().asDict()

    def _append(self, before: dict, **row) -> int:
        v = before["version"] + 1
        row = {**{k: before[k] for k in ("buckets", "layout", "deltas", "schema")}, "kind": "base", **row, "version": v}
        try:
            self._commits.create(f"{v:020d}.json", json.dumps(row))
        except FileExistsError:
            raise ConcurrentWrite(f"version {v} of {self.path} has been committed by another writer") from None
        return v

    # -- data -----------------------------------------------------------------------------

    def _bucket(self, buckets: int) -> Column:
        return slice_of(self.key, buckets).cast("int")

    def _write(self, rows: DataFrame, buckets: int) -> tuple[str, set[int], int]:
        """Rows in folders by bucket: folder, buckets that have rows, number of rows.  Large buckets become several files."""
        folder, seen = uuid.uuid4().hex, Observation()
        out = rows.observe(seen, F.count(F.lit(1)).alias("rows")).withColumn("_bucket", self._bucket(buckets))
        out.hint("rebalance", "_bucket").write.partitionBy("_bucket").parquet(f"{self.path}/data/{folder}")
        names = Folder(self.spark, f"{self.path}/data/{folder}").names()
        return folder, {int(n.partition("=")[2]) for n in names if n.startswith("_bucket=")}, _count(seen, "rows")

    def _touched(self, rows: DataFrame, buckets: int) -> list[int]:
        return sorted(r[0] for r in rows.select(self._bucket(buckets)).distinct().collect())

    def _files(self, schema: StructType, paths: list[str]) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _state(self, at: dict, buckets: Iterable[int] | None = None) -> DataFrame:
        """The state of a version, or of some of its buckets: stored rows with the open deltas merged in."""
        if at["version"] < 0:
            raise ValueError(f"empty store: {self.path}")
        schema = StructType.fromJson(json.loads(at["schema"]))
        wanted = range(at["buckets"]) if buckets is None else list(buckets)
        state = self._files(schema, [f"{self.path}/data/{at['layout'][b]}/_bucket={b}" for b in wanted if at["layout"][b]])
        if not at["deltas"]:
            return state
        held = [(f, self._buckets_of(f)) for f in at["deltas"]]
        changes = self._files(schema, [f"{self.path}/data/{f}/_bucket={b}" for f, has in held for b in wanted if b in has])
        return writes.put_newer(state, changes, self.key)

    def _buckets_of(self, folder: str) -> set[int]:
        return {int(n.partition("=")[2]) for n in Folder(self.spark, f"{self.path}/data/{folder}").names() if n.startswith("_bucket=")}

    def read(self) -> DataFrame:
        """The current state."""
        return self._state(self._latest())

    # -- writes ---------------------------------------------------------------------------

    def commit(self, state: DataFrame, batch: str | None = None) -> int:
        """Make ``state`` the next version, whole."""
        at = self._latest()
        folder, has, n = self._write(state, at["buckets"])
        layout = [folder if b in has else None for b in range(at["buckets"])]
        return self._append(at, batch=batch, rows=n, layout=layout, deltas=[], schema=state.schema.json())

    def _replace(self, at: dict, touched: Iterable[int], new: DataFrame, **row) -> int:
        """The next version with ``new`` in the touched buckets; the others keep their folders."""
        folder, has, n = self._write(new, at["buckets"])
        layout = list(at["layout"])
        for b in touched:
            layout[b] = folder if b in has else None
        return self._append(at, rows=n, layout=layout, **row)

    def _folded(self) -> dict:
        at = self._latest()
        if at["deltas"]:
            self.compact()
            at = self._latest()
        return at

    def put(self, changes: DataFrame, batch: str | None = None) -> int | None:
        """Upsert a change table; a batch already committed changes nothing.  Only buckets of changed keys are read and written."""
        if batch is not None and self.has_batch(batch):
            return None
        at = self._folded()
        if at["version"] < 0:
            first = writes.last_wins(changes, self.key)
            first = (first.where("_op <> 'remove'") if "_op" in first.columns else first).drop("_seq", "_op")
            return self.commit(first, batch)
        touched = self._touched(changes, at["buckets"])
        fn = writes.put_delete if "_op" in changes.columns else writes.put
        return self._replace(at, touched, fn(self._state(at, touched), changes, self.key), batch=batch)

    def feed(self, changes: DataFrame, batch: str, failed: int = 0) -> int | None:
        """One batch of an unbounded feed: only its changes are written, never the state.

        The stored rows keep ``_seq``, and tombstones where there is an ``_op``, so readers can merge the deltas in any order.  Another
        writer's commit between is no conflict, as a batch depends on no version.  ``compact`` folds the batches in, as a job of its own.
        """
        if self.has_batch(batch):
            return None
        at = self._latest()
        if at["schema"] and "_seq" not in StructType.fromJson(json.loads(at["schema"])).names:
            raise ValueError("a store that is fed keeps _seq in its rows; commit the first state with it")
        seen = Observation()
        folder, _, n = self._write(writes.last_wins(changes.observe(seen, F.count(F.lit(1)).alias("n")), self.key), at["buckets"])
        while True:
            try:
                row = {"deltas": [*at["deltas"], folder], "schema": at["schema"] or changes.schema.json()}
                return self._append(at, kind="delta", batch=batch, rows=n, changes=_count(seen, "n"), failed=failed, **row)
            except ConcurrentWrite:
                if self.has_batch(batch):
                    return None
                at = self._latest()

    def totals(self) -> DataFrame:
        """One row over all feed batches: ``batches, total, success, failure``, however many there were."""
        fed = self.commits().where("kind = 'delta'").dropDuplicates(["batch"])
        sums = fed.agg(F.count(F.lit(1)).alias("batches"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("changes", "failed")])
        return sums.select("batches", (F.col("changes") + F.col("failed")).alias("total"), F.col("changes").alias("success"), F.col("failed").alias("failure"))

    def compact(self) -> int:
        """Fold the open deltas into their buckets; batches that come meanwhile stay open."""
        at = self._latest()
        if not at["deltas"]:
            return at["version"]
        touched = sorted(set().union(*map(self._buckets_of, at["deltas"])))
        folder, has, n = self._write(self._state(at, touched), at["buckets"])
        now = at
        while True:
            if any(now["layout"][b] != at["layout"][b] for b in touched):
                raise ConcurrentWrite(f"buckets of {self.path} have been written while they were folded")
            layout = [(folder if b in has else None) if b in touched else f for b, f in enumerate(now["layout"])]
            try:
                return self._append(now, rows=n, layout=layout, deltas=[f for f in now["deltas"] if f not in at["deltas"]])
            except ConcurrentWrite:
                now = self._latest()

    def vacuum(self, keep: int = 1, older_than: float = 7 * 86_400.0) -> int:
        """Remove bucket folders that none of the last ``keep`` versions names and that are older than so many seconds; how many."""
        kept = self._all().orderBy(F.col("version").desc()).limit(keep)
        used = {(r["f"], r["b"]) for r in kept.select(F.posexplode("layout").alias("b", "f")).where("f IS NOT NULL").distinct().collect()}
        open_ = {r["f"] for r in kept.select(F.explode("deltas").alias("f")).distinct().collect()}
        gone = 0
        for folder in set(self._data.names()) - open_:
            inside = Folder(self.spark, f"{self.path}/data/{folder}")
            for name, at in inside.names().items():
                bucket = name.partition("=")[2]
                if bucket.isdigit() and (folder, int(bucket)) not in used and time.time() - at >= older_than:
                    inside.remove(name)
                    gone += 1
        return gone

    def dry_run(self, changes: DataFrame, valid: Column | None = None) -> DataFrame:
        """The bulk summary a put would report; nothing is written."""
        out = writes.bulk_put(self.read(), changes, self.key, valid=valid)
        return writes.feed_summary(changes, out.errors)

    # -- selection-wide work in resumable chunks --------------------------------------------

    def by_selection(
        self, selection: Column, ops: dict[str, FieldOp] | None = None, *, copy_to: "Store | None" = None
    ) -> int:
        """Update (``ops``), copy (``copy_to``) or delete everything selected; the affected count.

        Buckets without a selected row are not written.
        """
        at = self._folded()
        base = self._state(at)
        if copy_to is not None:
            return copy_chosen(base, selection, copy_to)
        chosen = base.where(F.coalesce(selection, F.lit(False))).groupBy(self._bucket(at["buckets"]).alias("b")).count().collect()
        affected, touched = sum(r["count"] for r in chosen), [r["b"] for r in chosen]
        if not touched:
            self._append(at, rows=0, affected=0)
            return 0
        part = self._state(at, touched)
        new = writes.update_by_selection(part, selection, ops) if ops is not None else writes.delete_by_selection(part, selection)
        self._replace(at, touched, new, affected=affected)
        return affected


def copy_chosen(base: DataFrame, selection: Column, to: Store, batch: str | None = None) -> int:
    """Put the selected rows into another store; the match is evaluated once."""
    chosen = cut(base.where(F.coalesce(selection, F.lit(False))))
    to.put(chosen if "_seq" in chosen.columns else chosen.withColumn("_seq", F.lit(0)), batch)
    return chosen.count()


def _append_row(spark: SparkSession, schema: str, row: tuple, path: str) -> None:
    fields = [f.strip().split(" ") for f in schema.split(",")]
    cols = [F.lit(v).cast(kind).alias(name) for (name, kind), v in zip(fields, row)]
    spark.range(1, numPartitions=1).select(*cols).write.mode("append").parquet(path)


class ChunkedSelection:
    """Resumable form: hash buckets of the key are worked one after the other.

    The source is stored once by bucket folder; each step reads one folder, writes its
    result folder, or puts its selected rows into another store, and appends a progress row.  The token is the next bucket, ``None`` when
    all are done.  A step repeated after a crash overwrites its own folder only.
    """

    PROGRESS = "chunk int, affected bigint"

    def __init__(self, spark: SparkSession, path: str, key: str, chunks: int):
        self.spark, self.path, self.key, self.chunks = spark, path.rstrip("/"), key, chunks

    def prepare(self, base: DataFrame) -> None:
        """Lay the documents out by chunk; hashed keys fill chunks evenly."""
        out = base.withColumn("_chunk", slice_of(self.key, self.chunks).cast("int"))
        out.hint("rebalance", "_chunk").write.partitionBy("_chunk").mode("overwrite").parquet(f"{self.path}/source")

    def progress(self) -> DataFrame:
        try:
            return self.spark.read.schema(self.PROGRESS).parquet(f"{self.path}/progress").dropDuplicates(["chunk"])
        except AnalysisException as e:
            _only_missing(e)
            return self.spark.createDataFrame([], self.PROGRESS)

    def token(self) -> int | None:
        """First chunk without a progress row."""
        nxt = self.spark.range(self.chunks).select(F.col("id").cast("int").alias("chunk"))
        row = nxt.join(self.progress(), "chunk", "left_anti").agg(F.min("chunk")).first()
        return row[0]

    def step(
        self, token: int | None, selection: Column, ops: dict[str, FieldOp] | None = None, copy: bool = False, copy_to: Store | None = None
    ) -> tuple[int, int | None]:
        """Work the chunk named by the token; (affected, next token).

        ``ops`` updates, ``copy_to`` puts the selected rows into that store, ``copy`` keeps only them as the result, and without any of
        these the selected rows are deleted.  A chunk is a batch of the other store, so one that is repeated is put once.
        """
        c = token if token is not None else 0
        seen = Observation()
        part = self.spark.read.parquet(f"{self.path}/source").where(F.col("_chunk") == c).drop("_chunk")
        if copy_to is not None:
            n = copy_chosen(part, selection, copy_to, f"copy {self.path} {c}")
            _append_row(self.spark, self.PROGRESS, (c, n), f"{self.path}/progress")
            return n, (c + 1 if c + 1 < self.chunks else None)
        if copy:
            done = part.where(F.coalesce(selection, F.lit(False))).observe(seen, F.count(F.lit(1)).alias("affected"))
        elif ops is not None:
            done = writes.update_by_selection(part, selection, ops, seen)
        else:
            done = writes.delete_by_selection(part, selection, seen)
        done.write.mode("overwrite").parquet(f"{self.path}/result/_chunk={c}")
        n = _count(seen, "affected")
        _append_row(self.spark, self.PROGRESS, (c, n), f"{self.path}/progress")
        return n, (c + 1 if c + 1 < self.chunks else None)

    def run(self, selection: Column, ops: dict[str, FieldOp] | None = None, copy: bool = False, copy_to: Store | None = None) -> int:
        """Continue from the last finished chunk to the end; affected rows of all chunks."""
        token = self.token()
        while token is not None:
            _, token = self.step(token, selection, ops, copy, copy_to)
        return self.progress().agg(F.coalesce(F.sum("affected"), F.lit(0))).first()[0]

    def result(self) -> DataFrame:
        """The rows of all chunks; an error while chunks are still to be worked."""
        left = self.token()
        if left is not None:
            raise ValueError(f"chunk {left} of {self.chunks} is not worked yet")
        return self.spark.read.parquet(f"{self.path}/result").drop("_chunk")
