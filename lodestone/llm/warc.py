"""WARC archives written and read by Spark, and their capture index by an external merge.

Archives are written by Spark's text writer, a record a row: its commit protocol leaves no part of a lost task behind, and any file
system that Spark knows will do. Each archive that is read back gives a run of index entries, sorted in its task. Runs are cut at
splitters over the whole key, so that a URL with very many captures is cut as well, and every range of keys is merged from its pieces of
runs by a loser tree.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestone.llm.common import store
from lodestone.session import is_small, scratch_path

#: Payloads of fewer bytes are always stored.
LEAST = 100
#: Entries of a range that a task merges, and the most ranges; beyond them ranges grow.
RANGE = 4096
MOST_RANGES = 16_384
#: Records of an archive at most.
RECORDS = 5_000

END = "\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_ENTRY = (
    "url_key string, captured string, page_id bigint, archive string, offset bigint, length bigint, record_type string, refers_to bigint, "
    "payload_bytes bigint, payload_digest string"
)
_KINDS = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32()}


def _schema(text: str) -> pa.Schema:
    return pa.schema([(name, _KINDS[kind]) for name, kind in (c.split() for c in text.split(", "))])


# -- writing -----------------------------------------------------------------------------------------


def decided(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """``page_id, url, html`` (null as empty) with ``payload_bytes, payload_digest`` and ``first``: the page whose payload is the same, else null.

    Only groups of two and more meet the pages in the join. Small tables of them are broadcast, behind a check of their size; larger
    ones are hashed by partition, and a payload that many pages share is split by the adaptive engine.
    """
    body = F.coalesce("html", F.lit(""))
    pages = pages.select("page_id", "url", body.alias("html"), F.octet_length(body).cast("bigint").alias("payload_bytes"), F.sha2(body, 256).alias("payload_digest"))
    groups = pages.where(F.col("payload_bytes") >= least).groupBy("payload_digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("pages"))
    groups = store(groups.where("pages > 1").drop("pages"), "equal-payloads")
    return pages.join(F.broadcast(groups) if is_small(groups) else groups.hint("shuffle_hash"), "payload_digest", "left")


def captured_at(page_id: Column) -> Column:
    """A time for tables without one: pages are captured in the order of their ids, one a second."""
    return F.timestamp_seconds(F.pmod(F.coalesce(page_id, F.lit(0)), F.lit(3_000_000_000)) + 946_684_800)


def records(pages: DataFrame, time: Column | None = None) -> DataFrame:
    """One ``value`` a page: its WARC record without the empty lines at its end.

    A page is a revisit if another page with the same payload has a smaller id; one with no id never stands before others. Line ends
    in a URL are percent-encoded, as they would end its header line. A page without a URL has a record without one.
    """
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    url = F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("payload_bytes").cast("string"), F.lit(END)
    )
    stored = F.when(revisit, 0).otherwise(F.col("payload_bytes"))
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">\r\n"))
    header = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: "), urn(F.col("page_id")),
        F.lit("WARC-Date: "), F.date_format(captured_at(F.col("page_id")) if time is None else time, "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        F.coalesce(F.concat(F.lit("\r\nWARC-Target-URI: "), url), F.lit("")),
        F.lit("\r\nWARC-Payload-Digest: sha256:"), F.col("payload_digest"),
        F.when(revisit, F.concat(F.lit(f"\r\nWARC-Profile: {_PROFILE}\r\nWARC-Refers-To: "), urn(F.col("first")))).otherwise("\r\n"),
        F.lit("Content-Type: application/http;msgtype=response\r\nContent-Length: "), (F.octet_length(http) + stored).cast("string"), F.lit(END),
    )
    return pages.select(F.concat(header, http, F.when(revisit, "").otherwise(F.col("html"))).alias("value"))


def write(pages: DataFrame, path: str, least: int = LEAST, time: Column | None = None) -> None:
    """Archives of all pages below ``path``, gzip-compressed as whole files."""
    writer = records(decided(pages, least), time).write.option("lineSep", END).option("compression", "gzip")
    writer.option("maxRecordsPerFile", RECORDS).text(path)


# -- reading -----------------------------------------------------------------------------------------


def url_key(url: str) -> str:
    """Host labels from the last to the first, then what follows: captures of a site and a folder stand together."""
    scheme, found, rest = url.partition("://")
    if not found:
        return url
    end = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    return ",".join(reversed(rest[:end].lower().split("."))) + ")" + rest[end:]


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.lower(): v for k, _, v in (x.partition(": ") for x in lines)}


def _page(urn: str | None) -> int | None:
    number = (urn or "")[len("<urn:page:") : -1]
    return int(number) if number else None


def parse(name: str, data: bytes) -> Iterator[tuple]:
    """An entry for each record of an archive; a record that does not end as told, or holds another payload, is an error."""
    at, gap = 0, END.encode()
    while at < len(data):
        start, stop = at, data.find(gap, at)
        warc = _fields(data[at:stop])
        body = stop + 4
        at = body + int(warc.get("content-length", -1))
        if not data.startswith(b"WARC/1.1\r\n", start) or data[at : at + 4] != gap:
            raise ValueError(f"{name}: broken record at byte {start}")
        cut = data.find(gap, body, at) + 4
        http = _fields(data[body : cut - 4])
        size, digest, kind = int(http["content-length"]), warc["warc-payload-digest"].removeprefix("sha256:"), warc["warc-type"]
        if kind == "response" and (at - cut, hashlib.sha256(data[cut:at]).hexdigest()) != (size, digest):
            raise ValueError(f"{name}: the payload at byte {cut} is not the one that was written")
        at += 4
        time = "".join(c for c in warc["warc-date"] if c.isdigit())
        yield (
            url_key(warc.get("warc-target-uri", "")), time, _page(warc["warc-record-id"]), name, start, at - start, kind,
            _page(warc.get("warc-refers-to")) if kind == "revisit" else None, size, digest,
        )


def _order(e: tuple) -> tuple:
    """URL key and time, then page (those without an id last) and place."""
    return e[0], e[1], e[2] is None, e[2] or 0, e[3], e[4]


def _batches(entries: list[tuple], schema: pa.Schema, step: int = 4096) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(entries), step):
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*entries[at : at + step]), schema.types)], schema=schema)


def runs(spark: SparkSession, path: str) -> DataFrame:
    """Index entries of all archives below ``path``; those of one archive are a run, sorted, with their place ``pos`` in it."""
    schema = _schema(_ENTRY + ", pos int")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("path"), batch.column("content")):
                name = unquote(name.as_py()).rpartition("/")[2]
                run = sorted(parse(name, zlib.decompress(content.as_py(), 31)), key=_order)
                yield from _batches([(*e, i) for i, e in enumerate(run)], schema)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(read, _ENTRY + ", pos int")


# -- merging -----------------------------------------------------------------------------------------


class LoserTree:
    """Merges sorted runs: each inner node keeps the loser of its match, so the next winner replays one path only."""

    def __init__(self, sources: Iterable[Iterable[tuple]], key):
        self.runs = [iter(s) for s in sources]
        self.key = key
        self.heads: list[tuple | None] = [None] * len(self.runs)
        for i in range(len(self.runs)):
            self._advance(i)
        self.losers = [-1] * len(self.runs)
        for i in range(len(self.runs)):
            self._replay(i)

    def _advance(self, i: int) -> None:
        e = next(self.runs[i], None)
        self.heads[i] = None if e is None else (self.key(e), i, e)

    def _beats(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return x is not None and (y is None or x[:2] < y[:2])

    def _replay(self, i: int) -> None:
        node = (i + len(self.runs)) // 2
        while node:
            other = self.losers[node]
            if other < 0:  # the tree is being built: wait here for the neighbour
                self.losers[node] = i
                return
            if self._beats(other, i):
                self.losers[node], i = i, other
            node //= 2
        self.losers[0] = i

    def __iter__(self) -> Iterator[tuple]:
        while self.runs and self.heads[i := self.losers[0]] is not None:
            yield self.heads[i][2]
            self._advance(i)
            self._replay(i)


def _splitters(entries: DataFrame, n: int, each: int = 20) -> list[tuple]:
    """Keys that cut the entries into ``n`` ranges about equal, from a sample of some twenty keys a range."""
    if n < 2:
        return []
    share = min(1.0, n * each / max(1, entries.count()))
    drawn = F.pmod(F.xxhash64("archive", "offset"), F.lit(1 << 30)) < int(share * (1 << 30))
    keys = sorted(_order(tuple(r)) for r in entries.where(drawn).select("url_key", "captured", "page_id", "archive", "offset").collect())
    return [keys[len(keys) * i // n] for i in range(1, n)] if keys else []


def merged(entries: DataFrame, size: int = RANGE) -> DataFrame:
    """All runs in one order by URL key, time and page, with the entry's ``position`` (from 0) in the whole."""
    ranges = max(1, min(MOST_RANGES, -(-entries.count() // size)))
    splitters = _splitters(entries, ranges)
    cut_schema, out_schema = _schema(_ENTRY + ", pos int, range int"), _schema(_ENTRY + ", range int, place int")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(zip(*(c.to_pylist() for c in batch.columns)))
            if rows:
                yield from _batches([(*r, bisect_right(splitters, _order(r))) for r in rows], cut_schema, len(rows))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, pieces, last = None, [], None
        for batch in batches:
            for r in zip(*(c.to_pylist() for c in batch.columns)):
                if r[-1] != at:
                    yield from _placed(at, pieces, out_schema)
                    at, pieces, last = r[-1], [], None
                if r[3] != last:
                    pieces.append([])
                    last = r[3]
                pieces[-1].append(r[:-2])
        yield from _placed(at, pieces, out_schema)

    pieces = entries.mapInArrow(cut, _ENTRY + ", pos int, range int").repartition(ranges, "range").sortWithinPartitions("range", "archive", "pos")
    out = store(pieces.mapInArrow(merge, _ENTRY + ", range int, place int"), "capture-index")
    # one row a range
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = out.groupBy("range").agg(F.count(F.lit(1)).alias("n")).select("range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return out.join(F.broadcast(starts), "range").withColumn("position", F.col("start") + F.col("place")).drop("range", "place", "start")


def _placed(at: int | None, pieces: list[list[tuple]], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    found = list(LoserTree(pieces, _order)) if pieces else []
    yield from _batches([(*e, at, i) for i, e in enumerate(found)], schema)


def archived(pages: DataFrame, path: str | None = None, least: int = LEAST, time: Column | None = None) -> DataFrame:
    """Writes ``pages`` (``page_id, url, html``) as archives, reads them back and returns their capture index.

    One row a page: ``url_key, captured, page_id, archive, offset, length, record_type, refers_to, payload_bytes, payload_digest,
    position``. Places are bytes of the uncompressed archive. A null payload is an empty one, stored like any below ``least`` bytes.
    Rows without an id are kept, and are revisits of a page that has one. Of repeated rows with the smallest id all are responses. If
    no page of a group has an id, all are responses. An empty table gives no rows. Other columns are not read.
    """
    path = path or scratch_path(pages.sparkSession, "warc")
    write(pages, path, least, time)
    return merged(store(runs(pages.sparkSession, path), "capture-runs"))
