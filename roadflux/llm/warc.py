"""WARC archives and their index, merged from locally sorted capture runs.

Writing: every capture becomes one WARC/1.1 record holding an HTTP response, and
every record a gzip member of its own, so an index offset is a place to seek to.
Members are packed until an archive has ``file_bytes``; each pack is a row that
Spark's text writer commits as a file, so archives survive lost executors on any file
system.  (The writer ends a row by a separator.  Here that is the last byte of
the last member, the highest byte of its size, which is 0 below 16 MB; a longer record
is followed by an empty member.)
Of captures with equal payloads of ``least_bytes`` or more, the one with the
largest id is a response, the others are revisits of it without a payload.

Reading: archives (gzip by record or whole, or plain) are parsed as a stream by Content-Length;
digests of responses are computed again and must agree with the header.

Index: each archive gives one run of captures, sorted by url key, timestamp and
id.  Runs are dealt to key ranges, where Spark's sort, which spills, puts the run parts one after another;
a loser tree merges the k parts of a range, decoding a few rows of each at a time, so ranges in
order are the capture histories of all urls in order.  The id is part
of the range key, so a url with any number of captures is cut like any other.

Defined cases: a null payload is empty; a null url has an empty key and no
target header; a null id is archived and can only be a response or a revisit of
another.  Rows repeated with the same id and payload are all responses.  A record that does not
begin a gzip member has a null offset.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadflux.storage import drop_folder, shared_folder

from .common import checkpointed, rekey
from .urlfilter import with_parts

END = "\r\n\r\n"
INDEX = "archive string, offset bigint, packed_bytes bigint, page_id bigint, url_key string, captured_at string, record_type string, refers_to bigint, payload_bytes bigint, payload_digest string"
NAMES = [x.split()[0] for x in INDEX.split(", ")]


def with_url_key(df: DataFrame) -> DataFrame:
    """Host labels reversed, then path and query: neighbours in a site are neighbours in the index."""
    parts = with_parts(df, "url", "_")
    key = F.when(F.instr("url", "://") > 0, F.concat(F.array_join(F.reverse(F.split("_host", r"\.")), ","), F.lit(")"), "_full")).otherwise("")
    return parts.withColumn("url_key", key).drop("_host", "_path", "_full", "_node")


def _header(name: str, value: Column) -> Column:
    safe = F.regexp_replace(value.cast("string"), r"[\x00-\x1f\x7f]", "")
    return F.when(value.isNull(), "").otherwise(F.concat(F.lit(name + ": "), safe, F.lit("\r\n")))


#: Ends a gzip member that is followed by nothing: an empty member.
EMPTY = gzip.compress(b"", mtime=0)


def member(record: bytes) -> bytes:
    """A gzip member (with an empty one behind it beyond 16 MB), whose last byte is 0."""
    packed = gzip.compress(record, 6, mtime=0)
    return packed if packed[-1] == 0 else packed + EMPTY


def packed(batches: Iterator[pa.RecordBatch], file_bytes: int, compress: bool) -> Iterator[pa.RecordBatch]:
    """Records to rows of whole archives, each without its last byte."""
    pack = bytearray()
    for batch in batches:
        for record in batch["record"]:
            pack += member(record.as_buffer()) if compress else record.as_buffer()
            if len(pack) >= file_bytes:
                yield pa.record_batch([pa.array([bytes(pack[:-1])], pa.binary())], ["value"])
                pack = bytearray()
    if pack:
        yield pa.record_batch([pa.array([bytes(pack[:-1])], pa.binary())], ["value"])


def write_archives(captures: DataFrame, folder: str, least_bytes: int = 1000, file_bytes: int = 1 << 24, compress: bool = True) -> None:
    """captures(page_id, url, payload string or binary, captured_at string) to ``folder``, archives of about ``file_bytes``."""
    payload = F.coalesce(F.col("payload").cast("binary"), F.lit("").cast("binary"))
    rows = captures.select(F.col("page_id").cast("bigint"), F.col("url").cast("string"), F.col("captured_at").cast("string"), payload.alias("payload"))
    rows = rows.withColumns({"digest": F.sha1("payload"), "bytes": F.octet_length("payload")})
    rows = rows.withColumn("h", F.xxhash64("digest", "bytes"))
    light = captures.select(F.col("page_id").cast("bigint"), F.sha1(payload).alias("digest"), F.octet_length(payload).cast("int").alias("bytes"))
    keepers = light.where(F.col("bytes") >= least_bytes).groupBy("digest", "bytes").agg(F.max("page_id").alias("keeper"), F.count("*").alias("n")).where("n > 1")
    keepers = keepers.select(rekey_hash("digest", "bytes"), F.col("digest").alias("kd"), "keeper")
    rows = rows.join(keepers, (F.col("h") == F.col("kh")) & (F.col("digest") == F.col("kd")), "left")
    rows = with_url_key(rows).withColumn("other", F.col("keeper").isNotNull() & ~F.col("keeper").eqNullSafe(F.col("page_id")))
    other = F.col("other")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes").cast("string"), F.lit(END))
    length = F.octet_length(http) + F.when(other, 0).otherwise(F.col("bytes"))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(other, "revisit").otherwise("response"), F.lit("\r\n"),
        F.concat(F.lit("WARC-Record-ID: <urn:capture:"), F.coalesce(F.col("page_id").cast("string"), F.lit("-")), F.lit(">\r\n")),
        _header("WARC-Date", F.col("captured_at")),
        _header("WARC-Target-URI", F.col("url")),
        _header("WARC-URL-Key", F.col("url_key")),
        F.when(other, F.concat(F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\nWARC-Refers-To: <urn:capture:"), F.col("keeper").cast("string"), F.lit(">\r\n"))).otherwise(""),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest"), F.lit("\r\nWARC-Payload-Length: "), F.col("bytes").cast("string")),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "), length.cast("string"), F.lit(END), http,
    )
    payload = F.when(other, F.lit("").cast("binary")).otherwise(F.col("payload"))
    record = F.concat(head.cast("binary"), payload, F.lit(END).cast("binary"))
    packs = rows.select(record.alias("record")).mapInArrow(lambda x: packed(x, file_bytes, compress), "value binary")
    # the cast of binary to string keeps every byte
    last = "\0" if compress else "\n"
    packs.select(F.col("value").cast("string")).write.option("lineSep", last).option("maxRecordsPerFile", 1).mode("overwrite").text(folder)


def rekey_hash(*columns: str) -> Column:
    return F.xxhash64(*columns).alias("kh")


class _Stream:
    """Buffered reader over an archive's bytes, unpacked as it is read; knows where members begin."""

    def __init__(self, content: memoryview) -> None:
        self.content, self.at, self.buffer, self.offset, self.made = content, 0, bytearray(), 0, 0
        self.unpack = zlib.decompressobj(31) if bytes(content[:2]) == b"\x1f\x8b" else None
        self.begins = {0: 0}  # place in the unpacked stream: place in the archive

    def _more(self) -> bool:
        part = bytes(self.content[self.at : self.at + (1 << 18)])
        self.at += len(part)
        if self.unpack is None:
            self.buffer += part
        else:
            while part:
                out = self.unpack.decompress(part)
                self.made += len(out)
                self.buffer += out
                part = self.unpack.unused_data if self.unpack.eof else b""
                if self.unpack.eof:
                    self.begins[self.made] = self.at - len(part)
                    self.unpack = zlib.decompressobj(31)
        return self.at < len(self.content) or bool(self.buffer)

    def place(self) -> int | None:
        """Where the archive must be opened to read on from here; None inside a member."""
        if self.unpack is None:
            return self.offset
        if not self.buffer and self.at >= len(self.content):
            return len(self.content)
        return self.begins.pop(self.offset, None)

    def until(self, mark: bytes) -> bytes | None:
        start = 0
        while (hit := self.buffer.find(mark, start)) < 0:
            start = max(0, len(self.buffer) - len(mark))
            if self.at >= len(self.content):
                return None
            self._more()
        return self.take(hit + len(mark))[: -len(mark)]

    def take(self, n: int) -> bytes:
        while len(self.buffer) < n:
            if self.at >= len(self.content):
                raise ValueError("archive ends inside a record")
            self._more()
        out = bytes(self.buffer[:n])
        del self.buffer[:n]
        self.offset += n
        return out


def records(content: memoryview) -> Iterator[tuple[int | None, dict[str, str], bytes]]:
    """(offset in the archive, headers, block) of every record."""
    stream = _Stream(content)
    while True:
        at, offset = stream.place(), stream.offset
        head = stream.until(END.encode())
        if head is None:
            if stream.buffer:
                raise ValueError("archive ends inside a record")
            return
        version, *lines = head.decode().split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"no WARC record at {offset}")
        headers = dict(x.split(": ", 1) for x in lines)
        block = stream.take(int(headers["Content-Length"]))
        if stream.take(4) != END.encode():
            raise ValueError(f"record at {offset} does not end where it should")
        yield at, headers, block


def payload_of(headers: dict[str, str], block: bytes) -> bytes:
    """The entity body of an HTTP message, or the block itself."""
    return block.partition(END.encode())[2] if headers.get("Content-Type", "").startswith("application/http") else block


def _number(value: str | None) -> int | None:
    value = (value or "").removeprefix("<urn:capture:").removesuffix(">")
    return int(value) if value not in ("", "-") else None


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """One locally sorted run of captures per archive below ``folder``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch["path"].to_pylist(), batch["content"], strict=True):
                rows, name = [], path.rsplit("/", 1)[1]
                for offset, head, block in records(memoryview(content.as_buffer())):
                    digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
                    if head["WARC-Type"] == "response" and hashlib.sha1(payload_of(head, block)).hexdigest() != digest:
                        raise ValueError(f"digest differs in {path} at {offset}")
                    rows.append((name, offset, _number(head["WARC-Record-ID"]), head.get("WARC-URL-Key", ""), head.get("WARC-Date", ""), head["WARC-Type"], _number(head.get("WARC-Refers-To")), int(head["WARC-Payload-Length"]), digest))
                ends = [r[1] for r in rows[1:]] + [content.as_buffer().size]
                rows = [(*r[:2], None if e is None or r[1] is None else e - r[1], *r[2:]) for r, e in zip(rows, ends, strict=True)]
                rows.sort(key=capture_key)
                yield pa.record_batch([pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), _TYPES, strict=True)] if rows else [pa.array([], t) for t in _TYPES], NAMES)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    return files.select("path", "content").mapInArrow(run, INDEX)


_TYPES = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()]


def capture_key(row: tuple) -> tuple:
    """url key (as UTF-8, which is Spark's order), time, id (null first), place."""
    return row[4].encode(), row[5].encode(), row[3] is not None, row[3] or 0, row[0], -1 if row[1] is None else row[1]


class Part:
    """A run's rows of one range as a sequence of tuples; ``rows`` of them are decoded at a time."""

    def __init__(self, table: pa.Table, rows: int = 256) -> None:
        self.table, self.rows, self.low, self.held = table, rows, 0, []

    def __len__(self) -> int:
        return self.table.num_rows

    def __getitem__(self, i: int) -> tuple:
        if not self.low <= i < self.low + len(self.held):
            part = self.table.slice(i, self.rows)
            self.low, self.held = i, list(zip(*(part[c].to_pylist() for c in NAMES), strict=True))
        return self.held[i - self.low]


class LoserTree:
    """k-way merge of sorted sequences: one comparison a level for each item taken.

    ``losers[1:]`` holds the loser of every inner match, ``losers[0]`` the winner.
    """

    def __init__(self, runs: list, key) -> None:
        self.runs, self.key, self.k = runs, key, len(runs)
        self.at = [0] * self.k
        self.heads = [(0, key(r[0]), i) if len(r) else (1, (), i) for i, r in enumerate(runs)]
        self.losers = [0] * max(self.k, 1)
        if self.k:
            self.losers[0] = self._play(1)

    def _play(self, match: int) -> int:
        if match >= self.k:
            return match - self.k
        a, b = self._play(2 * match), self._play(2 * match + 1)
        winner, self.losers[match] = (a, b) if self.heads[a] < self.heads[b] else (b, a)
        return winner

    def __iter__(self) -> Iterator:
        while self.k and not self.heads[winner := self.losers[0]][0]:
            own = self.runs[winner]
            yield own[self.at[winner]]
            self.at[winner] += 1
            here = self.at[winner]
            self.heads[winner] = (0, self.key(own[here]), winner) if here < len(own) else (1, (), winner)
            match = (winner + self.k) // 2
            while match:
                if self.heads[self.losers[match]] < self.heads[winner]:
                    winner, self.losers[match] = self.losers[match], winner
                match //= 2
            self.losers[0] = winner


def merged_index(runs: DataFrame, rows_per_range: int = 50_000) -> DataFrame:
    """Runs to one globally ordered index: partitions in order, rows in order inside them, numbered by ``position``."""
    runs = checkpointed(runs)
    ranges = max(1, -(-runs.count() // rows_per_range))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches, schema=pa.schema(list(zip(NAMES, _TYPES, strict=True)))).combine_chunks()
        names = table["archive"].combine_chunks().dictionary_encode().indices.to_numpy() if table.num_rows else np.zeros(0, np.int32)
        cuts = [0, *(np.flatnonzero(names[1:] != names[:-1]) + 1).tolist(), table.num_rows]
        parts = [Part(table.slice(a, b - a)) for a, b in zip(cuts[:-1], cuts[1:], strict=True) if b > a]
        out: list[tuple] = []
        for n, row in enumerate(LoserTree(parts, capture_key)):
            out.append((*row, n))
            if len(out) == 4096:
                yield as_batch(out)
                out = []
        if out:
            yield as_batch(out)

    def as_batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), [*_TYPES, pa.int64()], strict=True)], [*NAMES, "position"])

    order = ["url_key", "captured_at", "page_id", "archive", "offset"]
    keyed = runs.repartitionByRange(ranges, *order).sortWithinPartitions("archive", *order)
    return keyed.mapInArrow(merge, INDEX + ", position bigint")


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def captures_of(pages: DataFrame) -> DataFrame:
    """pages(page_id, url, html) as captures; the fetch time follows the id, as the table has none."""
    when = F.timestamp_seconds(F.lit(1704067200) + F.coalesce(F.col("page_id").cast("bigint"), F.lit(0)))
    return pages.select("page_id", "url", F.col("html").cast("string").alias("payload"), F.date_format(when, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("captured_at"))


__all__ = ["LoserTree", "captures_of", "drop_folder", "merged_index", "read_archives", "records", "scratch_folder", "write_archives"]
