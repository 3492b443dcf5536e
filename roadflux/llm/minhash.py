"""Near-duplicate documents: MinHash, banding, verification on full shingle sets.

1.  One pass over the texts makes, per document, its shingle count, a class id
    (a digest of the whole shingle set, held against a second one, so that 128
    bits agree), the band keys and a signature of
    one byte per universal-hash minimum.  Documents of equal sets form a class
    and only one member goes on, so copies never meet each other again.
2.  Band buckets with at least two classes are searched by breadth-first
    comparison of signatures; they yield a forest of likely links, not pairs.
    Buckets beyond ``bucket_rows`` are dealt into blocks and searched block pair
    by block pair, so no task holds a whole hot bucket and no pair is skipped.
3.  Components of the likely links bound the search.  Their members' full
    sets are compared exactly (integers, ``100 * common >= percent * union``), again
    breadth first and in block pairs, whose size is that of the sets
    (``block_shingles``), so the copies of a set follow its component's bytes and
    not its rows; confirmed links go through large-star / small-star once more.

A pair at the threshold misses every one of 32 bands of 4 rows with probability
5e-8; the likely-link margin is over four standard errors of the signature.

Defined cases: null, empty and word-less texts have an empty set and stay alone.
Repeated rows are separate rows; repeated ids share nothing but their id.  Null
ids come last in a group: where it has no other id, component_id is null and the
least text hash is the row that is kept.
Other columns of the input are neither read nor returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, rekey, without_clashes
from .components import connected_components
from .runs import by_run, reached
from .sieve import with_maybe
from .vectext import chunks, mix, shingle_sets, words

BANDS, ROWS = 32, 4
SECOND = 0x2545F4914F6CDD1D
MOST_SHINGLES = 1 << 20  # 8 MB of hashes in a block of a large component
_U = np.uint64


def universal_hashes(n: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.integers(1, 1 << 63, n, _U) * _U(2) + _U(1), rng.integers(0, 1 << 63, n, _U)


def signature(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Minima of the multiply-shift hashes a*x+b mod 2^64, in steps of bounded memory."""
    low = np.full(len(a), np.iinfo(_U).max, _U)
    for at in range(0, len(shingles), 1024):
        np.minimum(low, (np.multiply.outer(a, shingles[at : at + 1024]) + b[:, None]).min(axis=1), out=low)
    return low


def class_id(shingles: np.ndarray, salt: int = 0x517CC1B727220A95) -> int:
    """Digest of a whole set, as a bigint."""
    mixed = mix(shingles + _U(salt))
    total = mix(mixed.sum(dtype=_U, keepdims=True) + mix(np.array([len(shingles)], _U)))
    return int((total ^ mix(np.bitwise_xor.reduce(mixed, keepdims=True, initial=_U(0)))).view(np.int64)[0])


def sketches(docs: DataFrame, k: int) -> DataFrame:
    a, b = universal_hashes(BANDS * ROWS)
    salt = mix(np.arange(1, BANDS + 1, dtype=_U))
    scales = mix(np.arange(101, 101 + ROWS, dtype=_U)) | _U(1)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, off in chunks(batch["text"]):
                h, _, _, per = words(data, off)
                sets = shingle_sets(h, per, k)
                bands, sigs = [], []
                for s in sets:
                    if not len(s):
                        bands.append(None)
                        sigs.append(None)
                        continue
                    low = signature(s, a, b)
                    keys = mix((low.reshape(BANDS, ROWS) * scales).sum(axis=1, dtype=_U) + salt)
                    bands.append(keys.view(np.int64))
                    sigs.append((low & _U(255)).astype(np.uint8).tobytes())
                yield pa.record_batch(
                    [
                        batch["doc_id"].slice(lo, hi - lo).cast(pa.int64()),
                        batch["text_key"].slice(lo, hi - lo),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([class_id(s) if len(s) else None for s in sets], pa.int64()),
                        pa.array([class_id(s, SECOND) if len(s) else None for s in sets], pa.int64()),
                        pa.array(bands, pa.list_(pa.int64())),
                        pa.array(sigs, pa.binary()),
                    ],
                    ["doc_id", "text_key", "n_shingles", "cid", "twin", "bands", "sig"],
                )

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"), F.xxhash64("text").alias("text_key"))
    return rows.mapInArrow(sketch, "doc_id bigint, text_key bigint, n_shingles bigint, cid bigint, twin bigint, bands array<bigint>, sig binary")


def in_blocks(df: DataFrame, group: str, size: str, rows: int, member: str, most: int | None = None) -> DataFrame:
    """One row per block pair that a row takes part in: task, block, block_lo, block_hi.

    A group whose ``size`` (rows, or any sum over its rows) is up to ``rows`` is
    one block.  A larger one is dealt into blocks of about half that and every
    pair of blocks becomes a task, so that each pair of members meets in some task.
    ``most``: blocks of large groups grow to this, as long as 16 of them do; a row is then copied
    that often and no more, until the groups are so large that blocks of ``most`` do not suffice.
    """
    budget = F.greatest(F.lit(rows), F.least(F.col(size) / 8, F.lit(most or rows)))
    blocks = F.when(F.col(size) <= rows, 1).otherwise(F.ceil(F.col(size) * 2 / budget)).cast("int")
    own = F.pmod(F.xxhash64(member, F.lit(5)), F.col("_n")).cast("int")
    dealt = df.withColumn("_n", blocks).withColumn("_b", own)
    others = F.filter(F.sequence(F.lit(0), F.col("_n") - 1), lambda x: x != F.col("_b"))
    dealt = dealt.withColumn("_o", F.explode(F.when(F.col("_n") == 1, F.array(F.lit(0))).otherwise(others)))
    dealt = dealt.withColumns({"block": F.col("_b"), "block_lo": F.least("_b", "_o"), "block_hi": F.greatest("_b", "_o")})
    return dealt.withColumn("task", F.xxhash64(group, "block_lo", "block_hi")).drop("_n", "_b", "_o")


def likely_links(classes: DataFrame, least: float, bucket_rows: int) -> DataFrame:
    """Forest edges (u, v) of classes that share a band and agree in ``least`` of their signatures."""
    spread = classes.select("cid", F.explode("bands").alias("bucket"))
    shared = spread.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1").select(rekey("bucket"), "size")
    members = spread.join(shared, "bucket").join(classes.select("cid", "sig"), "cid")

    def search(runs: Iterator) -> Iterator[pa.RecordBatch]:
        for table, cuts in runs:
            ids = table["cid"].to_numpy()
            sigs = np.frombuffer(b"".join(table["sig"].to_pylist()), np.uint8).reshape(len(ids), -1)
            found: set[tuple[int, int]] = set()
            twos = cuts[:-1][np.diff(cuts) == 2]
            if len(twos):
                near = (sigs[twos] == sigs[twos + 1]).mean(axis=1) >= least
                found.update(zip(ids[twos[near]].tolist(), ids[twos[near] + 1].tolist(), strict=True))
            for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                if hi - lo > 2:
                    order = lo + np.argsort(ids[lo:hi])  # the same smallest member starts in every band, so links repeat and fold
                    own, names = sigs[order], ids[order]
                    found.update((int(names[x]), int(names[y])) for x, y in reached(hi - lo, lambda i, left, own=own: (own[left] == own[i]).mean(axis=1) >= least))
            edges = np.array(sorted(found), np.int64).reshape(-1, 2)
            yield pa.record_batch([pa.array(edges[:, 0]), pa.array(edges[:, 1])], ["u", "v"])

    return by_run(in_blocks(members, "bucket", "size", bucket_rows, "cid").select("task", "cid", "sig"), "task", search, "u bigint, v bigint")


def same_enough(parts: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Forest of the links 100 * common >= percent * union among sorted sets."""
    if len(parts) == 2:
        common = len(np.intersect1d(parts[0], parts[1], assume_unique=True))
        return [(0, 1)] if 100 * common >= percent * (len(parts[0]) + len(parts[1]) - common) else []
    sizes = np.array([len(x) for x in parts], np.int64)
    vocabulary, codes = np.unique(np.concatenate(parts), return_inverse=True)
    ends = np.cumsum(sizes)
    heads = ends - sizes
    mark = np.zeros(len(vocabulary), np.int64)

    def linked(i: int, left: np.ndarray) -> np.ndarray:
        mine = codes[heads[i] : ends[i]]
        mark[mine] = 1
        if len(left) * 4 > len(sizes):
            common = np.add.reduceat(mark[codes], heads)[left]
        else:
            common = np.array([mark[codes[heads[j] : ends[j]]].sum() for j in left.tolist()], np.int64)
        mark[mine] = 0
        return 100 * common >= percent * (sizes[i] + sizes[left] - common)

    return reached(len(parts), linked)


def confirmed_links(docs: DataFrame, groups: DataFrame, k: int, percent: int, block_shingles: int) -> DataFrame:
    """Forest edges of exact links; groups(cid, digest, twin, key, component, size): one member of each class.

    key: the member's id, or its text hash where all of the class lack an id.
    """

    def to_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, off in chunks(batch["text"]):
                h, _, _, per = words(data, off)
                sets, part = shingle_sets(h, per, k), batch.slice(lo, hi - lo)
                told = zip(sets, part["digest"].to_pylist(), part["twin"].to_pylist(), strict=True)
                own = [len(s) > 0 and class_id(s) == c and class_id(s, SECOND) == d for s, c, d in told]
                kept = part.filter(pa.array(own, pa.bool_()))  # another text under the same key falls out
                yield pa.record_batch([kept["cid"], kept["component"], kept["size"], pa.array([s.tobytes() for s, x in zip(sets, own, strict=True) if x], pa.binary())], ["cid", "component", "size", "shingles"])

    own_id = F.col("doc_id").cast("bigint")
    texts = docs.select(F.coalesce(own_id, F.xxhash64("text")).alias("key"), F.col("text").cast("string"), own_id.isNull().alias("_none"))
    likely = with_maybe(texts, "key", groups, "key", "_may").where("_may").drop("_may")  # most texts stay where they are
    likely = likely.where("not _none").unionByName(likely.where("_none").dropDuplicates(["key"]))  # copies without an id have one key
    sets = likely.join(groups.hint("merge"), "key").select("text", "cid", "digest", "twin", "component", "size").mapInArrow(to_sets, "cid bigint, component bigint, size bigint, shingles binary")

    def confirm(runs: Iterator) -> Iterator[pa.RecordBatch]:
        for table, cuts in runs:
            ids, blobs, edges = table["cid"].to_numpy(), table["shingles"], []
            for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                names, at = np.unique(ids[lo:hi], return_index=True)
                if len(names) > 1:
                    parts = [np.frombuffer(blobs[lo + x].as_buffer(), _U) for x in at.tolist()]
                    edges += [(int(names[x]), int(names[y])) for x, y in same_enough(parts, percent)]
            both = np.array(edges, np.int64).reshape(-1, 2)
            yield pa.record_batch([pa.array(both[:, 0]), pa.array(both[:, 1])], ["u", "v"])

    return by_run(in_blocks(sets, "component", "size", block_shingles, "cid", max(block_shingles, MOST_SHINGLES)).select("task", "cid", "shingles"), "task", confirm, "u bigint, v bigint")


def grouped(docs: DataFrame, k: int, percent: int, margin: float, bucket_rows: int, block_shingles: int) -> DataFrame:
    """(doc_id, text_key, n_shingles, component, first) per row; first: the least (doc_id, text_key) of its group, null ids last."""
    rows = without_clashes(checkpointed(sketches(docs, k).withColumn("digest", F.col("cid"))), "cid", "twin")
    full = rows.where("cid is not null")
    own = [F.first(c).alias(c) for c in ("digest", "twin", "n_shingles", "bands", "sig")]
    classes = checkpointed(full.groupBy("cid").agg(F.coalesce(F.min("doc_id"), F.min("text_key")).alias("key"), *own))
    coarse = connected_components(likely_links(classes.select("cid", "bands", "sig"), percent / 100 - margin, bucket_rows))
    members = coarse.withColumnRenamed("node", "cid").join(classes.select("cid", "digest", "twin", "n_shingles", "key"), "cid")
    members = checkpointed(members)
    sized = members.groupBy("component").agg(F.sum("n_shingles").alias("size")).select(rekey("component"), "size")
    groups = checkpointed(members.join(sized, "component").drop("n_shingles"))
    exact = connected_components(confirmed_links(docs, groups, k, percent, block_shingles))
    merged = rows.select("doc_id", "text_key", "n_shingles", "cid").join(exact.select(F.col("node").alias("cid"), F.col("component")), "cid", "left")
    merged = checkpointed(merged.select("doc_id", "text_key", "n_shingles", F.coalesce("component", "cid").alias("component")))
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key"))
    named = merged.where("component is not null").groupBy("component").agg(least.alias("least"))
    named = named.select(rekey("component"), F.struct("least.doc_id", "least.text_key").alias("first"))
    return merged.join(named, "component", "left")


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, margin: float = 0.15, bucket_rows: int = 2048, block_shingles: int = 1 << 15) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of docs(doc_id, text)."""
    out = grouped(docs, k, percent, margin, bucket_rows, block_shingles)
    out = out.withColumn("component_id", F.coalesce("first.doc_id", "doc_id"))
    nameless = F.col("component_id").isNull() & F.coalesce(F.col("text_key") == F.col("first.text_key"), F.lit(True))
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), nameless).alias("kept"))


def deduplicated(docs: DataFrame, k: int = 5, percent: int = 80, margin: float = 0.15, bucket_rows: int = 2048, block_shingles: int = 1 << 15) -> DataFrame:
    """The rows of docs, all columns, with one row of every group: the least (doc_id, text hash), null ids last.

    Texts without a word stay, every one of them.  Rows repeated whole count as one.
    """
    found = checkpointed(grouped(docs, k, percent, margin, bucket_rows, block_shingles).where("component is not null").select("doc_id", "text_key", "first"))
    same = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & F.col("text_key").eqNullSafe(F.col("first.text_key"))
    gone = checkpointed(found.where(~same & F.col("first").isNotNull()).select(F.col("doc_id").alias("gone_id"), F.col("text_key").alias("gone_key")).distinct())
    text = F.col("text").cast("string")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("bigint").alias("id"), F.xxhash64(text).alias("key"), F.coalesce(text.rlike(r"[^\x20\x09-\x0D]"), F.lit(False)).alias("worded"))
    rows = with_maybe(rows, "key", gone, "gone_key", "may")
    asked = rows.where("may")  # the others have no partner among the rows that go, and are not shuffled
    left = rows.where("not may").unionByName(asked.join(gone.hint("merge"), F.col("id").eqNullSafe(F.col("gone_id")) & (F.col("key") == F.col("gone_key")), "left_anti"))
    if not found.where(same).groupBy("doc_id", "text_key").count().where("count > 1").isEmpty():
        left = left.where("worded").dropDuplicates(["id", "key"]).unionByName(left.where("not worded"))
    return left.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
