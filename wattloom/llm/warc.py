"""WARC archives and their index, merged from locally sorted runs.

Every task writes the pages it reads as one archive, a gzip member per record. What it knows of its
records is sorted by (URL key, timestamp, id) and written as runs of a bounded number of captures.
Runs are merged outside memory: the key space is cut at splitters into ranges, a task reads its
range's slice of up to FAN_IN runs as streams and puts them through a loser tree, and with more runs
the merged ones are merged again. The parts of the last pass, in order of their ranges, are one
index in global order, in which the captures of a URL stand together by time. Records are read back
through that index, archive by archive.

A payload that several pages have is stored once, with the page of the largest id; the others are
``revisit`` records that refer to it. Payloads below a size are always stored.
"""

from __future__ import annotations

import hashlib
import json
import zlib
from bisect import bisect_right
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattloom.llm.common import file_system, fresh_folder, saved, small, write_once

MIN_SHARED_BYTES = 1000
FAN_IN = 64
RUN_CAPTURES = 50_000
RANGE_CAPTURES = 20_000
#: More ranges would not help, and the splitters stay few; a range is streamed whatever its size.
MAX_RANGES = 2_000
SAMPLE_KEYS = 20_000
BLOCK = 1 << 20
#: A reading task takes about so many bytes of archives.
READ_BYTES = 64 << 20
#: Times outside of these have no 14 digits; the nearer one stands for them.
FIRST_TIME, LAST_TIME = "0001-01-01 00:00:00", "9999-12-31 23:59:59"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def url_key(url: Column) -> Column:
    """The host turned round, then path and query in lower case: com,example,www)/path?query.
    Scheme, fragment and a leading www. do not count; white space is written as %20."""
    text = F.regexp_replace(F.lower(F.coalesce(url, F.lit(""))), r"\s", "%20")
    text = F.regexp_replace(F.regexp_replace(text, r"#.*$", ""), r"^[a-z][a-z0-9+.-]*://", "")
    host = F.regexp_replace(F.regexp_extract(text, r"^([^/?]*)", 1), r"^www\.", "")
    rest = F.regexp_replace(text, r"^[^/?]*", "")
    turned = F.concat_ws(",", F.reverse(F.split(host, r"\.")))
    return F.concat(turned, F.lit(")"), F.when(rest == "", "/").otherwise(rest))


class LoserTree:
    """Merges sorted iterators: the least head wins, each inner node keeps the loser of its match,
    so the next winner costs one match per level."""

    END = (1,)

    def __init__(self, runs: Sequence[Iterator]):
        self.runs = [iter(run) for run in runs]
        self.size = max(1, len(self.runs))
        self.heads = [self.pull(i) for i in range(self.size)]
        self.losers = [0] * self.size
        self.winner = self.build(1) if self.runs else 0

    def pull(self, i: int) -> tuple:
        """The next item as (0, item, run), or END, which is greater than all of them."""
        if i < len(self.runs):
            for item in self.runs[i]:
                return (0, item, i)
        return self.END

    def build(self, node: int) -> int:
        if node >= self.size:
            return node - self.size
        left, right = self.build(2 * node), self.build(2 * node + 1)
        won, lost = (left, right) if self.heads[left] <= self.heads[right] else (right, left)
        self.losers[node] = lost
        return won

    def __iter__(self) -> Iterator:
        while self.heads[self.winner] != self.END:
            yield self.heads[self.winner][1]
            won = self.winner
            self.heads[won] = self.pull(won)
            node = (won + self.size) // 2
            while node:
                lost = self.losers[node]
                if self.heads[lost] < self.heads[won]:
                    self.losers[node], won = won, lost
                node //= 2
            self.winner = won


class Capture(NamedTuple):
    key: str
    timestamp: str
    id: str
    more: str

    def line(self) -> bytes:
        return "\t".join(self).encode() + b"\n"


def captures_of(line: bytes) -> Capture:
    return Capture(*line.rstrip(b"\n").decode().split("\t"))


def sortable(id: int | None) -> str:
    """An id as text that sorts like the number, NULL first."""
    return "-" if id is None else f"{id + (1 << 63):020d}"


def page_urn(id: int | None) -> str:
    return f"<urn:page:{'none' if id is None else id}>"


def page_of(urn: str) -> int | None:
    text = urn.removeprefix("<urn:page:").removesuffix(">")
    return None if text == "none" else int(text)


def record(row: dict) -> bytes:
    """One gzip member. The HTTP header of a revisit still tells the length of the payload."""
    payload = row["payload"].encode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    revisit = row["refers_to"] is not None
    block = http.encode() + (b"" if revisit else payload)
    t = row["timestamp"]
    fields = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": page_urn(row["id"]),
        "WARC-Target-URI": row["uri"],
        "WARC-Date": f"{t[:4]}-{t[4:6]}-{t[6:8]}T{t[8:10]}:{t[10:12]}:{t[12:]}Z",
        "WARC-Payload-Digest": f"sha1:{row['digest']}",
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    if revisit:
        fields |= {"WARC-Profile": PROFILE, "WARC-Refers-To": page_urn(row["refers_to"])}
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items()) + "\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head.encode() + block + b"\r\n\r\n") + packer.flush()


def parse_record(packed: bytes) -> dict:
    """Fields, HTTP length and payload of one member; a wrong length or digest is an error."""
    raw = zlib.decompress(packed, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    if rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("a record does not end where it says")
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(http.decode().rpartition("Content-Length: ")[2])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if fields["WARC-Type"] == "response" and (
        len(payload) != length or hashlib.sha1(payload).hexdigest() != digest
    ):
        raise ValueError("a payload is not what its record says")
    return {
        "page_id": page_of(fields["WARC-Record-ID"]),
        "payload_bytes": length,
        "payload_digest": digest,
        "record_type": fields["WARC-Type"],
        "refers_to": page_of(fields["WARC-Refers-To"]) if "WARC-Refers-To" in fields else None,
    }


def planned(pages: DataFrame, id: str, url: str, text: str, captured: Column, min_bytes: int) -> DataFrame:
    """Rows (id, uri, payload, key, timestamp, digest, refers_to)."""
    first, last = (F.lit(t).cast("timestamp") for t in (FIRST_TIME, LAST_TIME))
    time = F.greatest(first, F.least(last, F.coalesce(captured, F.timestamp_seconds(F.lit(0)))))
    rows = pages.select(
        F.col(id).cast("long").alias("id"),
        F.regexp_replace(F.coalesce(F.col(url), F.lit("")), r"\s", "%20").alias("uri"),
        F.coalesce(F.col(text), F.lit("")).alias("payload"),
        url_key(F.col(url)).alias("key"),
        F.date_format(time, "yyyyMMddHHmmss").alias("timestamp"),
    ).withColumn("digest", F.sha1("payload"))
    large = F.octet_length("payload") >= min_bytes
    # Equal payloads, pre-aggregated; only those that more than one page has are joined back.
    stored = (
        rows.where(large).groupBy("digest").agg(F.max("id").alias("stored"), F.count("*").alias("pages"))
    )
    stored = saved(stored.where("pages > 1").select("digest", "stored"), "stored-payloads")
    refers = F.when(large & ~F.col("id").eqNullSafe(F.col("stored")), F.col("stored"))
    return rows.join(small(stored), "digest", "left").withColumn("refers_to", refers).drop("stored")


def splitters(rows: DataFrame) -> list[tuple[str, str, str]]:
    """Keys that cut the captures into ranges of about RANGE_CAPTURES, from a bounded sample."""
    keys = rows.select("key", "timestamp", "id")
    ranges = min(MAX_RANGES, -(-keys.count() // RANGE_CAPTURES))
    if ranges <= 1:
        return []
    sample = keys.orderBy(F.xxhash64("key", "timestamp", "id")).limit(SAMPLE_KEYS).collect()
    ordered = sorted((row.key, row.timestamp, sortable(row.id)) for row in sample)
    return [ordered[len(ordered) * i // ranges] for i in range(1, ranges)]


SPANS = "range long, file string, start long, length long, captures long"
SPAN_NAMES = ["range", "file", "start", "length", "captures"]


def span_batch(spans: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
    columns = list(zip(*spans, strict=True)) or [[] for _ in kinds]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], SPAN_NAMES
    )


def write_run(folder: str, captures: list[Capture], cuts: list[tuple]) -> list[tuple]:
    """Sort captures, write them as a run and return the span of each range in it."""
    captures.sort()
    lines = [c.line() for c in captures]
    name = write_once(folder, ".run", [b"".join(lines)])
    spans: dict[int, list[int]] = {}
    at = 0
    for capture, line in zip(captures, lines, strict=True):
        span = spans.setdefault(bisect_right(cuts, capture[:3]), [at, 0, 0])
        span[1] += len(line)
        span[2] += 1
        at += len(line)
    return [(r, name, *span) for r, span in spans.items()]


def lines_of(folder: str, file: str, start: int, length: int) -> Iterator[bytes]:
    """The lines of a span, read block by block."""
    files, place = file_system(folder)
    with files.open_input_file(f"{place}/{file}") as source:
        rest, at, end = b"", start, start + length
        while at < end:
            block = source.read_at(min(BLOCK, end - at), at)
            at += len(block)
            *lines, rest = (rest + block).split(b"\n")
            for line in lines:
                yield line + b"\n"


def merge_spans(folder: str, spans: DataFrame, fan_in: int = FAN_IN) -> DataFrame:
    """Merge until every range is one file; the result has one span per range, in order."""
    while True:
        place = Window.partitionBy("range").orderBy("file", "start")
        grouped = spans.withColumn("group", F.floor((F.row_number().over(place) - 1) / fan_in))
        tasks = grouped.groupBy("range", "group").agg(
            F.collect_list(F.struct("file", "start", "length")).alias("parts")
        )
        tasks = saved(tasks, "merge-tasks")

        def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for task in batch.to_pylist():
                    runs = [
                        map(captures_of, lines_of(folder, p["file"], p["start"], p["length"]))
                        for p in task["parts"]
                    ]
                    totals = [0, 0]

                    def merged():
                        for capture in LoserTree(runs):  # noqa: B023
                            line = capture.line()
                            totals[0] += len(line)  # noqa: B023
                            totals[1] += 1  # noqa: B023
                            yield line

                    name = write_once(folder, ".cdx", merged())
                    yield span_batch([(task["range"], name, 0, *totals)])

        count = tasks.count()
        ranges = tasks.select("range").distinct().count()
        spans = saved(tasks.repartition(max(1, count)).mapInArrow(merge, SPANS), "merged-spans")
        if count == ranges:
            return spans.orderBy("range")


class Archive(NamedTuple):
    """Archives and runs in ``folder``; one index file per range, in order of ranges."""

    folder: str
    index: DataFrame


def write_archive(
    pages: DataFrame, captured: Column, id: str = "page_id", url: str = "url", text: str = "html",
    min_bytes: int = MIN_SHARED_BYTES, folder: str | None = None, fan_in: int = FAN_IN,
) -> Archive:
    """Write one record per row and the merged index.

    ``captured`` is the time of capture, 1970 if NULL, and kept within the years 1 to 9999. NULL texts
    are empty payloads, NULL urls have the key ``)/``. A row with a NULL id is a revisit if a row with
    an id has its payload, and nothing refers to it. Rows equal in id and payload are both stored.
    Captures equal in key and time are ordered by id. An empty table gives an index without files.
    """
    folder = folder or fresh_folder(pages.sparkSession, "warc")
    rows = planned(pages, id, url, text, captured, min_bytes)
    cuts = splitters(rows.select("key", "timestamp", "id"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans: list[tuple] = []
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        held: list[tuple] = []

        def records():
            at = 0
            batch = first
            while batch is not None:
                for start in range(0, batch.num_rows, 256):
                    for row in batch.slice(start, 256).to_pylist():
                        packed = record(row)
                        kind = "response" if row["refers_to"] is None else "revisit"
                        held.append((row["key"], row["timestamp"], sortable(row["id"]), row["uri"], kind, at, len(packed)))
                        at += len(packed)
                        yield packed
                batch = next(batches, None)

        file = write_once(folder, ".warc.gz", records())
        for start in range(0, len(held), RUN_CAPTURES):
            captures = [
                Capture(key, time, page, json.dumps(
                    {"url": uri, "type": kind, "filename": file, "offset": at, "length": size}
                ))
                for key, time, page, uri, kind, at, size in held[start : start + RUN_CAPTURES]
            ]
            spans += write_run(folder, captures, cuts)
        yield span_batch(spans)

    columns = ["id", "uri", "payload", "key", "timestamp", "digest", "refers_to"]
    spans = saved(rows.select(*columns).mapInArrow(write, SPANS), "run-spans")
    return Archive(folder, merge_spans(folder, spans, fan_in))


CAPTURES = "part long, place long, key string, timestamp string, filename string, start long, length long"


def read_index(archive: Archive) -> DataFrame:
    """All captures in global order of (part, place): key, timestamp, file and span of the record."""
    folder = archive.folder

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in CAPTURES.split(", ")]
        kinds = [pa.int64() if "long" in f else pa.string() for f in CAPTURES.split(", ")]
        for batch in batches:
            for span in batch.to_pylist():
                rows: list[tuple] = []
                lines = lines_of(folder, span["file"], span["start"], span["length"])
                for place, line in enumerate(lines):
                    capture = captures_of(line)
                    more = json.loads(capture.more)
                    rows.append((
                        span["range"], place, capture.key, capture.timestamp,
                        more["filename"], more["offset"], more["length"],
                    ))
                    if len(rows) == 10_000:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names
                        )
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names
                    )

    index = archive.index
    return index.repartition(max(1, index.count())).mapInArrow(read, CAPTURES)


RECORDS = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("refers_to", T.LongType()),
    ]
)


def read_records(archive: Archive) -> DataFrame:
    """One row per record, read from the archives by the spans in the index. The records of a stretch
    of an archive are read in one go; no payload leaves its task."""
    folder = archive.folder
    captures = saved(read_index(archive).select("filename", "start", "length"), "captures")
    # A number given is kept; left to adaptive execution, spans look small enough for one task.
    total = captures.agg(F.sum("length")).first()[0] or 0
    tasks = max(captures.sparkSession.sparkContext.defaultParallelism, -(-total // READ_BYTES))
    ordered = captures.repartitionByRange(tasks, "filename", "start").sortWithinPartitions("filename", "start")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, place = file_system(folder)
        name, source = None, None
        schema = pa.schema(
            [(f.name, pa.int64() if f.dataType == T.LongType() else pa.string()) for f in RECORDS]
        )
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                if row["filename"] != name:
                    name = row["filename"]
                    if source:
                        source.close()
                    source = files.open_input_file(f"{place}/{name}")
                rows.append(parse_record(source.read_at(row["length"], row["start"])))
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return ordered.mapInArrow(read, RECORDS)
