"""Language identification by interpolated Kneser-Ney character models.

Training counts the highest-order character n-grams of every training text:
each task sorts and counts its own, Spark sums them per (language, n-gram).
Counts of the lower orders are continuation counts, i.e. numbers of distinct
left extensions, so they follow from the same table, in Spark.  The model is a set of
sorted 64-bit hash arrays, one per order, with one column of interpolated log
probabilities a language; lookups go through the leading hash bits.  No n-gram is
left out at any size: beyond ``cells`` probabilities the two highest orders are cut into shards,
each of which scores its own n-grams of all texts in a pass, and the sums add up.

Texts are folded to lower-case letters with their combining marks, everything else being one blank.  A
character of the basic plane takes 16 bits, so four of them pack into one
integer without loss; letters beyond it share the 8,192 codes from 0xD800 on.

The best language has the lowest cross-entropy per letter-or-blank.  Whether it is
accepted depends on a ceiling per language and length class, calibrated on training
texts that a trial model has not seen (a tenth of them by text hash; the final model
learns from all).  Their entropies under their own language are what should pass.
With the true language's model taken away, the best of the others shows what a text
of an unknown language scores, which should not pass.  The ceiling lies as many
standard deviations above the former as below the latter, but at least ``least`` and
at most ``sigmas`` above.
score = the softmax of the languages' cross-entropies over a fixed number of
characters, so long texts do not saturate it at once.

Defined cases: null, empty and letterless texts give ``und``, score 0, rejected.
Null languages are not learned from; with no training text at all, every text
is ``und``.  Repeated rows are scored alike; ties go to the first language by name.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from unicodedata import category

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from roadflux.storage import release

from .common import checkpointed
from .vectext import mix

ORDER = 4
CHUNK = 1 << 19
CELLS = 1 << 25  # log probabilities of a shard: 128 MB
LENGTHS = np.array([16, 64, 256, 1024, 1 << 62])  # calibration classes by folded length
_U = np.uint64


@lru_cache(1)
def _fold_table() -> tuple[np.ndarray, np.ndarray]:
    """Per code point: its code (lower-case letter or mark, else blank, 32) and whether it is a letter."""
    table, letter = np.full(0x110000, 32, np.uint16), np.zeros(0x110000, bool)
    for cp in range(0x110000):
        if 0xD800 <= cp < 0xE000 or 0xFE00 <= cp < 0xFE10:  # variation selectors are no part of a word
            continue
        c = chr(cp)
        letter[cp] = c.isalpha()
        if letter[cp] or category(c)[0] == "M":
            code = ord(c.lower()[0])
            table[cp] = code if code < 0x10000 else 0xD800 + (code & 0x1FFF)
    return table, letter


def folded(text: str | None) -> np.ndarray:
    """Codes with single blanks around and between words; empty if there is no letter."""
    if not text:
        return np.zeros(0, np.uint16)
    table, letter = _fold_table()
    raw = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    if not letter[raw].any():
        return np.zeros(0, np.uint16)
    code = np.concatenate((np.array([32], np.uint16), table[raw], np.array([32], np.uint16)))
    blank = code == 32
    return code[np.concatenate(([True], ~(blank[1:] & blank[:-1])))]


def grams(code: np.ndarray, order: int = ORDER) -> np.ndarray:
    """Packed n-grams ending at every character but the leading blank; short histories are padded with 0."""
    padded = np.concatenate((np.zeros(order - 1, _U), code.astype(_U)))
    total = np.zeros(len(code), _U)
    for i in range(order):
        total = (total << _U(16)) | padded[i : i + len(code)]
    return total[1:]


class Tally:
    """Counts of packed n-grams, compacted as they come in."""

    def __init__(self) -> None:
        self.parts: list[np.ndarray] = []
        self.held, self.keys, self.counts = 0, np.zeros(0, _U), np.zeros(0, np.int64)

    def add(self, found: np.ndarray) -> None:
        self.parts.append(found)
        self.held += len(found)
        if self.held > CHUNK:
            self.compact()

    def compact(self) -> None:
        if self.held:
            keys, counts = np.unique(np.concatenate(self.parts), return_counts=True)
            every, back = np.unique(np.concatenate((self.keys, keys)), return_inverse=True)
            self.counts = np.bincount(back, np.concatenate((self.counts, counts)), len(every)).astype(np.int64)
            self.keys, self.parts, self.held = every, [], 0


def pieces(code: np.ndarray) -> Iterator[np.ndarray]:
    """Overlapping stretches of a long text, so that memory follows the stretch and every n-gram occurs once."""
    step = CHUNK
    for at in range(0, max(len(code) - 1, 0), step):
        yield grams(code[max(0, at - ORDER + 2) : at + step + 1])[at - max(0, at - ORDER + 2) :] if at else grams(code[: step + 1])


def trial_fold() -> Column:
    """The tenth of the texts, all copies of a text alike, that the trial model does not learn."""
    return F.pmod(F.xxhash64(F.col("text").cast("string"), F.lit(10)), F.lit(10)) == 0


def counted(docs: DataFrame) -> DataFrame:
    """(lang, gram, n, n_trial) over all rows of docs(text, lang); n_trial: without the texts kept for calibration."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tallies: dict[tuple[str, bool], Tally] = {}
        for batch in batches:
            for text, *key in zip(batch["text"], batch["lang"].to_pylist(), batch["kept"].to_pylist(), strict=True):
                for found in pieces(folded(text.as_py())):
                    tallies.setdefault(tuple(key), Tally()).add(found)
        for (lang, kept), tally in tallies.items():
            tally.compact()
            for at in range(0, len(tally.keys), CHUNK):
                keys, n = tally.keys[at : at + CHUNK], tally.counts[at : at + CHUNK]
                yield pa.record_batch([pa.array([lang] * len(keys), pa.string()), pa.array(keys.view(np.int64)), pa.array(n), pa.array(n * (not kept))], ["lang", "gram", "n", "n_trial"])

    rows = docs.where("lang is not null and text is not null").select(F.col("text").cast("string"), F.col("lang").cast("string"), trial_fold().alias("kept"))
    return rows.mapInArrow(run, "lang string, gram bigint, n bigint, n_trial bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"), F.sum("n_trial").alias("n_trial"))


def shard_of(grams_: np.ndarray, shards: int) -> np.ndarray:
    """By the two middle characters of a 4-gram, which are the first two of the 3-gram below it and of its context."""
    return (((grams_ >> _U(32)) & _U(0xFFFF)) * _U(31) + ((grams_ >> _U(16)) & _U(0xFFFF))) % _U(shards)


def shard_column(shards: int) -> Column:
    """The same in Spark."""
    part = lambda bits: F.shiftright("gram", bits).bitwiseAND(F.lit(0xFFFF))
    return F.pmod(part(32) * 31 + part(16), F.lit(shards))


class KneserNey:
    """Interpolated Kneser-Ney probabilities of all languages over one set of sorted hash arrays.

    levels: per language and order the sorted packed m-grams with their counts; cuts: the discounts.
    Of the two highest orders a model may hold one shard only: all that the
    probability of a 4-gram needs lies in the 4-gram's own shard or in the two lowest orders.
    """

    def __init__(self, langs: list[str], levels: list[list[tuple[np.ndarray, np.ndarray]]], cuts: list[list[float]], alphabet: int, shard: int = 0, shards: int = 1) -> None:
        self.langs, self.order, self.shard, self.shards = langs, ORDER, shard, shards
        size = len(langs)
        self.floor = np.full(size, -np.log(alphabet + 1.0))
        self.keys: list[np.ndarray] = []
        self.logp: list[np.ndarray] = []
        self.back: list[tuple[np.ndarray, np.ndarray]] = []
        self.heads: list[np.ndarray] = []
        lower = None
        for m in range(1, self.order + 1):
            packed = np.unique(np.concatenate([p[m - 1][0] for p in levels])) if langs else np.zeros(0, _U)
            contexts = np.unique(packed >> _U(16))
            gamma, own = np.ones((len(contexts), size)), []
            for j, level in enumerate(levels):
                keys, counts = level[m - 1]
                at = np.searchsorted(contexts, keys >> _U(16))
                total = np.bincount(at, counts, len(contexts))
                types = np.bincount(at, minlength=len(contexts))
                cut = cuts[j][m - 1]
                with np.errstate(divide="ignore", invalid="ignore"):
                    gamma[:, j] = np.where(total > 0, cut * types / total, 1.0)
                    own.append((keys, np.maximum(counts - cut, 0) / total[at]))
            logp = np.empty((len(packed), size), np.float32)
            for lo in range(0, len(packed), CHUNK):  # in double precision a stretch at a time only
                part = packed[lo : lo + CHUNK]
                below = np.tile(np.exp(self.floor), (len(part), 1)) if lower is None else lower(part & _U((1 << 16 * (m - 1)) - 1))
                prob = np.zeros((len(part), size))
                for j, (keys, seen) in enumerate(own):
                    first, end = np.searchsorted(keys, part[0]), np.searchsorted(keys, part[-1], "right")
                    prob[np.searchsorted(part, keys[first:end]), j] = seen[first:end]
                logp[lo : lo + CHUNK] = np.log(prob + gamma[np.searchsorted(contexts, part >> _U(16))] * below)
            self._add(packed, logp, contexts, np.log(gamma))
            lower = lambda grams_, m=m: np.exp(self._level(grams_, m))

    @staticmethod
    def _sorted(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        hashes = mix(keys + _U(1))
        at = np.argsort(hashes)
        hashes = hashes[at]
        return hashes, values.astype(np.float32, copy=False)[at], np.searchsorted(hashes >> _U(48), np.arange((1 << 16) + 1, dtype=_U)).astype(np.int32)

    def _add(self, packed: np.ndarray, logp: np.ndarray, contexts: np.ndarray, gamma: np.ndarray) -> None:
        hashes, values, heads = self._sorted(packed, logp)
        self.keys.append(hashes)
        self.logp.append(values)
        self.heads.append(heads)
        self.back.append(self._sorted(contexts, gamma))

    @staticmethod
    def _find(hashes: np.ndarray, heads: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """Position in the sorted hash array, -1 if absent: buckets by 16 leading bits, then halving inside."""
        if not len(hashes):
            return np.full(len(wanted), -1)
        top = (wanted >> _U(48)).astype(np.int64)
        lo, end = heads[top], heads[top + 1]
        for _ in range(int(np.diff(heads).max()).bit_length()):
            mid = (lo + end) >> 1
            right = (lo < end) & (hashes[np.minimum(mid, len(hashes) - 1)] < wanted)
            end = np.where(right | (lo >= end), end, mid)
            lo = np.where(right, mid + 1, lo)
        at = np.minimum(lo, len(hashes) - 1)
        return np.where(hashes[at] == wanted, at, -1)

    def _level(self, found: np.ndarray, m: int) -> np.ndarray:
        """Log probabilities of packed m-grams, (n, languages)."""
        if m == 0:
            return np.tile(self.floor, (len(found), 1)).astype(np.float32)
        at = self._find(self.keys[m - 1], self.heads[m - 1], mix(found + _U(1)))
        out = self.logp[m - 1][at] if len(self.logp[m - 1]) else np.zeros((len(found), len(self.langs)), np.float32)
        missing = np.flatnonzero(at < 0)
        if len(missing):
            some = found[missing]
            hashes, gamma, heads = self.back[m - 1]
            there = self._find(hashes, heads, mix((some >> _U(16)) + _U(1)))
            weight = np.where(there[:, None] >= 0, gamma[there], np.float32(0)) if len(hashes) else np.float32(0)
            out[missing] = weight + self._level(some & _U((1 << 16 * (m - 1)) - 1), m - 1)
        return out

    def totals(self, found: np.ndarray, owner: np.ndarray, texts: int) -> np.ndarray:
        """(texts, languages): sums of log probability of the packed n-grams of this shard, by the text that they belong to."""
        if self.shards > 1:
            mine = shard_of(found, self.shards) == self.shard
            found, owner = found[mine], owner[mine]
        every, back = np.unique(found, return_inverse=True)
        logp = self._level(every, self.order)
        return np.stack([np.bincount(owner, logp[:, j].astype(np.float64)[back], texts) for j in range(len(self.langs))], axis=1)


class Counts:
    """Counts of all orders as tables, and what is small of them: languages, discounts, alphabet, number of shards.

    The driver never holds more than the model of one shard, about ``cells`` log probabilities.
    """

    def __init__(self, counts: DataFrame, n: str, cells: int) -> None:
        top = counts.where(F.col(n) > 0).select("lang", "gram", F.col(n).alias("n"))
        self.orders = [top]
        for m in range(ORDER - 1, 0, -1):  # distinct left extensions
            shorter = self.orders[0].groupBy("lang", F.col("gram").bitwiseAND(F.lit((1 << 16 * m) - 1)).alias("gram")).agg(F.count("*").alias("n"))
            self.orders.insert(0, checkpointed(shorter))
        told = [{r["lang"]: r for r in t.groupBy("lang").agg(F.count("*").alias("all"), F.count_if(F.col("n") == 1).alias("ones"), F.count_if(F.col("n") == 2).alias("twos")).collect()} for t in self.orders]
        self.langs = sorted(told[0])
        cut = lambda r: r["ones"] / (r["ones"] + 2 * r["twos"]) if r["ones"] and r["twos"] else 0.5
        self.cuts = [[cut(level[x]) for level in told] for x in self.langs]
        self.alphabet = self.orders[0].select("gram").distinct().count()
        rows = sum(r["all"] for level in told[2:] for r in level.values())
        self.shards = max(1, -(-rows * len(self.langs) // cells))

    def model(self, shard: int = 0) -> KneserNey:
        levels: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in self.langs]
        for m, table in enumerate(self.orders, 1):
            own = table.where(shard_column(self.shards) == shard) if m > 2 and self.shards > 1 else table
            found = own.toArrow().combine_chunks()
            lang = found["lang"].combine_chunks().dictionary_encode()
            keys, n, codes = found["gram"].to_numpy().view(_U), found["n"].to_numpy().astype(np.float64), lang.indices.to_numpy()
            names = lang.dictionary.to_pylist()
            for j, x in enumerate(self.langs):
                at = np.flatnonzero(codes == names.index(x)) if x in names else np.zeros(0, np.int64)
                at = at[np.argsort(keys[at])]
                levels[j].append((keys[at], n[at]))
        return KneserNey(self.langs, levels, self.cuts, self.alphabet, shard, self.shards)


def train(docs: DataFrame) -> KneserNey:
    """The model of every n-gram of every training text, in one piece."""
    return Counts(checkpointed(counted(docs)), "n", 1 << 62).model()


def _sums(model: KneserNey, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(texts, languages) sums of log probability in the model's shard, and the numbers of characters."""
    size = len(model.langs)
    sums, lengths = np.zeros((len(texts), size)), np.zeros(len(texts), np.int64)
    held: list[tuple[int, np.ndarray]] = []

    def flush() -> None:
        if held and size:
            owner = np.repeat([i for i, _ in held], [len(x) for _, x in held])
            sums[:] += model.totals(np.concatenate([x for _, x in held]), owner, len(texts))
        held.clear()

    waiting = 0
    for i, text in enumerate(texts):
        code = folded(text)
        lengths[i] = max(len(code) - 1, 0)
        for found in pieces(code):
            held.append((i, found))
            waiting += len(found)
            if waiting >= CHUNK:
                flush()
                waiting = 0
    flush()
    return sums, lengths


def _entropies(model: KneserNey, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(texts, languages) cross-entropies in nats a character by a model in one piece, and the numbers of characters."""
    sums, lengths = _sums(model, texts)
    return -sums / np.maximum(lengths, 1)[:, None], lengths


def with_entropies(docs: DataFrame, counts: Counts, keep: list[str], text: str = "text") -> DataFrame:
    """keep + _h array<double>, a cross-entropy per language, and _n, the characters; kept columns travel untouched.

    A model of several shards takes as many passes; texts and sums so far are written between them.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_row"), F.col(text).cast("string").alias("_text"), F.lit(None).cast("array<double>").alias("_sums"))
    kind = rows.schema["_row"]
    for shard in range(counts.shards):
        shared, last, before = docs.sparkSession.sparkContext.broadcast(counts.model(shard)), shard == counts.shards - 1, rows

        def run(batches: Iterator[pa.RecordBatch], shared=shared, last=last) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, 512):
                    part = batch.slice(at, 512)
                    sums, lengths = _sums(shared.value, part["_text"].to_pylist())
                    if part["_sums"].null_count < part.num_rows:
                        sums = sums + np.array(part["_sums"].to_pylist()).reshape(sums.shape)
                    width = sums.shape[1]
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(0, (len(sums) + 1) * width, width) if width else np.zeros(len(sums) + 1, np.int64), pa.int32()), pa.array(sums.ravel()))
                    yield pa.record_batch([part["_row"], pa.array(lengths) if last else part["_text"], lists], ["_row", "_n" if last else "_text", "_sums"])

        middle = StructField("_n", LongType()) if last else StructField("_text", StringType())
        rows = rows.mapInArrow(run, StructType([kind, middle, StructField("_sums", ArrayType(DoubleType()))]))
        if not last:
            rows = checkpointed(rows)
        if shard > 0 and not last:
            release(before)
    entropies = F.transform("_sums", lambda x: -x / F.greatest(F.col("_n"), F.lit(1)))
    return rows.select(*[F.col(f"_row.`{c}`").alias(c) for c in keep], entropies.alias("_h"), "_n")


def length_class() -> Column:
    out = F.lit(len(LENGTHS) - 1)
    for i in range(len(LENGTHS) - 2, -1, -1):
        out = F.when(F.col("_n") <= int(LENGTHS[i]), i).otherwise(out)
    return out


def decided(found: DataFrame, langs: list[str], ceilings: np.ndarray, keep: list[str]) -> DataFrame:
    """keep + (lang_pred, score, rejected) from entropies; ceilings: (languages, length classes)."""
    if not langs:
        return found.select(*[F.col(f"`{c}`") for c in keep], F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("rejected"))
    none, best = F.col("_n") == 0, F.array_position("_h", F.array_min("_h")).cast("int")
    out = found.withColumns({"_low": F.array_min("_h"), "_best": best})
    limits = F.array(*[F.lit(float(x)) for x in ceilings.ravel()])
    limit = F.element_at(limits, (F.col("_best") - 1) * len(LENGTHS) + length_class() + 1)
    spread = F.aggregate("_h", F.lit(0.0), lambda acc, x: acc + F.exp(-F.least("_n", F.lit(20)) * (x - F.col("_low"))))
    return out.select(
        *[F.col(f"`{c}`") for c in keep], F.when(none, "und").otherwise(F.element_at(F.array(*[F.lit(x) for x in langs]), F.col("_best"))).alias("lang_pred"),
        F.when(none, 0.0).otherwise(1 / spread).alias("score"), (none | (F.col("_low") > limit)).alias("rejected"),
    )


def trials(docs: DataFrame, counts: Counts) -> DataFrame:
    """(lang, class, own, entropy): what docs(text, lang) score under their language, if it is the best, and under the best of the others."""
    names = F.array(*[F.lit(x) for x in counts.langs]) if counts.langs else F.array().cast("array<string>")
    out = with_entropies(docs.withColumn("_truth", F.col("lang").cast("string")), counts, ["_truth"])
    out = out.withColumn("_at", F.array_position(names, F.col("_truth")).cast("int")).where("_n > 0 and _at > 0")
    others = F.transform("_h", lambda x, i: F.when(i + 1 == F.col("_at"), float("inf")).otherwise(x))
    out = out.withColumns({"_others": others, "_right": F.array_position("_h", F.array_min("_h")) == F.col("_at")})
    name = lambda i: F.element_at(names, i.cast("int"))
    own = F.when(F.col("_right"), F.struct(F.col("_truth").alias("lang"), F.lit(True).alias("own"), F.array_min("_h").alias("entropy")))
    far = F.when(F.size("_h") > 1, F.struct(name(F.array_position("_others", F.array_min("_others"))).alias("lang"), F.lit(False).alias("own"), F.array_min("_others").alias("entropy")))
    return out.select(length_class().alias("class"), F.explode(F.array_compact(F.array(own, far))).alias("e")).select("e.lang", "class", "e.own", "e.entropy")


def ceilings_of(found: DataFrame, langs: list[str], least: float, sigmas: float, least_texts: int = 20) -> np.ndarray:
    """(languages, length classes) from ``trials``.

    Where fewer than ``least_texts`` texts of a language speak for a class, those of all
    languages do; if they are too few as well, there is no ceiling.
    """
    stats = found.cube("lang", "class", "own").agg(F.count("*").alias("texts"), F.avg("entropy").alias("mean"), F.coalesce(F.stddev_samp("entropy"), F.lit(0.0)).alias("sd"))
    told = {(r["lang"], r["class"], r["own"]): (r["texts"], r["mean"], max(r["sd"], 0.02)) for r in stats.where("class is not null and own is not null").collect() if r["texts"] >= least_texts}
    out = np.full((len(langs), len(LENGTHS)), np.inf)
    for i, lang in enumerate(langs):
        for kind in range(len(LENGTHS)):
            own = told.get((lang, kind, True)) or told.get((None, kind, True))
            others = told.get((lang, kind, False)) or told.get((None, kind, False))
            if own and others:
                apart = (others[1] - own[1]) / (own[2] + others[2])
                out[i, kind] = own[1] + own[2] * min(max(apart, least), sigmas)
            elif own:
                out[i, kind] = own[1] + own[2] * sigmas
    return out


def identify(docs: DataFrame, learn: Column, keep: list[str], least: float = 8.0, sigmas: float = 12.0, cells: int = CELLS) -> DataFrame:
    """keep + (lang_pred, score, rejected) for every row of docs(text, lang).

    ``learn`` marks the rows whose text and lang may be learned from; the ceilings of
    rejection come from the tenth of them that the trial model left out.
    ``keep`` names the columns to carry; ``cells`` bounds what a model holds in memory at a time.
    """
    known = docs.where(learn).where("lang is not null and text is not null")
    table = checkpointed(counted(known))
    trial, full = Counts(table, "n_trial", cells), Counts(table, "n", cells)
    ceilings = ceilings_of(trials(known.where(trial_fold()), trial), full.langs, least, sigmas)
    return decided(with_entropies(docs, full, keep), full.langs, ceilings, keep)
