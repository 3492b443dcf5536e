"""Benchmark decontamination: pigeonhole pieces, exact hits, Myers verification.

Item and document are normalised (lower case, runs of anything but letters and
digits become one blank).  An item of m characters has an error budget of
``floor(m * rate)`` edits and is cut into budget+1 pieces: an occurrence
within the budget leaves at least one piece untouched.  One Aho-Corasick pass
over a text finds all pieces of all items; around each hit, Myers' bit-parallel
algorithm (one Python integer a column) finds the least edit distance of the
whole item to any substring.

Items go out in blocks of bounded size (``block_chars``), one pass over the documents
for each, so neither the driver, which holds one block at a time, nor the broadcast nor the
automaton grows with the benchmark.  A worker keeps the automaton of its block from task to task.

Defined cases: null and empty texts match nothing.  Items whose normal form is
shorter than ``least_chars`` are matched without edits and as whole words, those
without a letter or digit not at all.  Repeated items or documents each give their own rows; null ids are kept
as null.  Of several places the least distance counts, then the first end.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

_OTHER = regex.compile(r"[^\p{L}\p{N}]+")


def normal(text: str | None) -> str:
    return _OTHER.sub(" ", (text or "").lower()).strip()


def cut(item: str, rate: float) -> tuple[int, list[tuple[int, str]]]:
    """(error budget, [(offset, piece)]): budget+1 pieces of almost equal length."""
    budget = int(len(item) * rate)
    edges = [len(item) * i // (budget + 1) for i in range(budget + 2)]
    return budget, [(a, item[a:b]) for a, b in zip(edges[:-1], edges[1:], strict=True)]


class Myers:
    """Least edit distance of a pattern to the substrings of a text."""

    def __init__(self, pattern: str) -> None:
        self.size = len(pattern)
        self.peq: dict[str, int] = {}
        for i, c in enumerate(pattern):
            self.peq[c] = self.peq.get(c, 0) | 1 << i

    def best(self, text: str, budget: int) -> tuple[int, int] | None:
        """(distance, end) of the first best match within ``budget``, or None."""
        top, full = 1 << (self.size - 1), (1 << self.size) - 1
        plus, minus, score = full, 0, self.size
        found, least = None, budget + 1
        for end, c in enumerate(text, 1):
            eq = self.peq.get(c, 0)
            xv = eq | minus
            xh = (((eq & plus) + plus) ^ plus) | eq
            ph, mh = minus | (full & ~(xh | plus)), plus & xh
            if ph & top:
                score += 1
            elif mh & top:
                score -= 1
            ph, mh = (ph << 1) & full, (mh << 1) & full
            plus, minus = mh | (full & ~(xv | ph)), ph & xv
            if score < least:
                least, found = score, (score, end)
                if not score:
                    break
        return found


def joined(windows: list[list[int]]) -> list[list[int]]:
    """[begin, stop] of windows in order of the text, those that overlap as one."""
    out: list[list[int]] = []
    for begin, stop, *_ in sorted(windows):
        if out and begin <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
        else:
            out.append([begin, stop])
    return out


class Matcher:
    """All items of one block."""

    def __init__(self, items: list[tuple[int | None, str]], rate: float, least_chars: int = 0) -> None:
        import ahocorasick

        self.least = least_chars
        self.items, self.budgets, self.patterns = [i for i, _ in items], [], []
        self.normals = [t for _, t in items]
        self.automaton = ahocorasick.Automaton()
        where: dict[str, list[tuple[int, int]]] = {}
        for n, (_, text) in enumerate(items):
            budget, pieces = cut(text, rate) if len(text) >= least_chars else (0, [(0, text)])
            self.budgets.append(budget)
            self.patterns.append(None)
            for at, piece in pieces:
                where.setdefault(piece, []).append((n, at))
        for piece, places in where.items():
            self.automaton.add_word(piece, (len(piece), places))
        if where:
            self.automaton.make_automaton()

    def matches(self, text: str) -> Iterator[tuple[int | None, int, int]]:
        """(item id, distance, end in the normalised text)."""
        if not len(self.automaton) or not text:
            return
        windows: dict[int, list[list[int]]] = {}
        short: dict[int, int] = {}
        for last, (size, places) in self.automaton.iter(text):
            for n, at in places:
                if len(self.normals[n]) < self.least:
                    if (last + 1 == len(text) or text[last + 1] == " ") and (last + 1 == size or text[last - size] == " "):
                        short.setdefault(n, last + 1)
                    continue
                begin = last + 1 - size - at - self.budgets[n]
                stop = last + 1 - size - at + len(self.normals[n]) + self.budgets[n]
                own = windows.setdefault(n, [])
                if own and begin <= own[-1][2]:  # overlapping windows of one item are verified once
                    own[-1][0] = min(own[-1][0], begin)  # of equal pieces the one at the later offset comes last
                    own[-1][1] = max(own[-1][1], stop)
                    own[-1][2] = max(own[-1][2], begin + self.budgets[n] * 2)
                else:
                    own.append([begin, stop, begin + self.budgets[n] * 2])
        for n, end in short.items():
            yield self.items[n], 0, end
        for n, own in windows.items():
            best = None
            budget = self.budgets[n]
            whole = text.find(self.normals[n])
            if whole >= 0:
                yield self.items[n], 0, whole + len(self.normals[n])
                continue
            if self.patterns[n] is None:
                self.patterns[n] = Myers(self.normals[n])
            for begin, stop in joined(own):
                begin = max(begin, 0)
                hit = self.patterns[n].best(text[begin:stop], budget if best is None else best[0] - 1)
                if hit and (best is None or hit[0] < best[0]):
                    best = hit[0], hit[1] + begin
            if best:
                yield self.items[n], *best


_MATCHER: dict[tuple, Matcher] = {}


class Block:
    """A broadcast of items under a name of its own, by which workers know it again."""

    def __init__(self, spark: SparkSession, items: list[tuple[int | None, str]]) -> None:
        self.name, self.shared = uuid.uuid4().hex, spark.sparkContext.broadcast(tuple(items))

    def matcher(self, rate: float, least_chars: int) -> Matcher:
        key = self.name, rate, least_chars
        if key not in _MATCHER:
            _MATCHER.clear()  # one block at a time
            _MATCHER[key] = Matcher(list(self.shared.value), rate, least_chars)
        return _MATCHER[key]


def contaminated(docs: DataFrame, benchmark: DataFrame, rate: float = 0.08, least_chars: int = 32, block_chars: int = 4_000_000) -> DataFrame:
    """(doc_id, item_id, distance, match_end): one row per document and item found in it.

    docs(doc_id, text), benchmark(item_id, text); documents without a match have no row.
    """
    kinds = dict(docs.dtypes)["doc_id"], dict(benchmark.dtypes)["item_id"]
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).where("text != ''")
    out = None
    for block in item_blocks(benchmark, block_chars):

        def run(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            matcher = block.matcher(rate, least_chars)
            for batch in batches:
                found = [(i, *m) for i, text in enumerate(batch["text"]) for m in matcher.matches(normal(text.as_py()))]
                at, item, distance, end = map(list, zip(*found, strict=True)) if found else ([], [], [], [])
                ids = batch["doc_id"].take(pa.array(at, pa.int64()))
                yield pa.record_batch([ids, pa.array(item, batch_type(kinds[1])), pa.array(distance, pa.int32()), pa.array(end, pa.int64())], ["doc_id", "item_id", "distance", "match_end"])

        part = rows.mapInArrow(run, f"doc_id {kinds[0]}, item_id {kinds[1]}, distance int, match_end bigint")
        out = part if out is None else out.unionByName(part)
    return out


def item_blocks(benchmark: DataFrame, block_chars: int) -> list[Block]:
    """Broadcasts of (item_id, normalised text), each of about ``block_chars`` at most."""
    items = benchmark.select("item_id", F.col("text").cast("string").alias("text")).where("text != ''")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_chars))
    out = []
    for block in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        texts = [(r["item_id"], normal(r["text"])) for r in own]
        out.append(Block(benchmark.sparkSession, [x for x in texts if x[1]]))
    return out


def batch_type(kind: str) -> pa.DataType:
    return {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]


def clean(docs: DataFrame, benchmark: DataFrame, rate: float = 0.08, least_chars: int = 32, block_chars: int = 4_000_000) -> DataFrame:
    """The rows of docs, all columns, whose text holds no benchmark item; no row is moved."""
    for block in item_blocks(benchmark, block_chars):

        def run(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            matcher = block.matcher(rate, least_chars)
            for batch in batches:
                keep = [next(matcher.matches(normal(text.as_py())), None) is None for text in batch["_text"]]
                yield pa.record_batch([batch["_row"].filter(pa.array(keep, pa.bool_()))], ["_row"])

        row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
        kind = StructType([StructField("_row", docs.schema, False)])
        kept = docs.select(row.alias("_row"), F.col("text").cast("string").alias("_text")).mapInArrow(run, kind)
        docs = kept.select(*[F.col(f"_row.`{c}`").alias(c) for c in docs.columns])
    return docs
