"""Near-duplicate vectors: random-hyperplane sign hashing, exact cosine, components.

Equal vectors of one label form a class (two 64-bit digests agree); classes are hashed by the
signs of ``bits`` random projections in several tables, and by a sketch of ``SKETCH`` more signs.

1.  Only (class, bucket, sketch) travel to the buckets.  A member goes on if another
    one of its bucket has a sketch near enough, so a vector is sent to
    the tables where it may have a partner and to no other.
2.  Vectors of these members are compared in double precision, inside bounded
    blocks.  A pair that meets in several buckets is counted in the first of them
    alone, which both sides know from their own codes, so per-bucket link counts
    simply add up and links are never listed pair by pair; a bucket gives a forest
    for the components.

Projections are sums of integers below 2^53, exact in double precision in any
order, so a vector has the same codes wherever they are computed.

``bits`` follows the largest label's size and ``tables`` follows from it, so
that a pair at the threshold shares no bucket with probability ``miss`` at most, at any
size: p = 1 - acos(threshold)/pi is the chance of one equal sign, and
(1 - p^bits)^tables <= miss.  The limit of differing sketch signs is the least
that such a pair exceeds with probability ``miss`` at most.

Defined cases: null labels, null or empty vectors, zero vectors and vectors with null or
non-finite components link with nothing; vectors of other lengths never link.
Repeated rows are rows of their own.  A null vec_id is linked like any other,
but never names a component unless it has no other member (then null).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, rekey, without_clashes
from .components import connected_components
from .minhash import in_blocks
from .runs import by_run, reached


SKETCH = 128


def hash_shape(largest: int, threshold: float, miss: float = 1e-6) -> tuple[int, int]:
    """(bits, tables): about 64 random rows a bucket in the largest label, misses bounded by ``miss``."""
    bits = min(48, max(6, math.ceil(math.log2(max(largest, 1) / 64 + 1))))
    p = 1 - math.acos(threshold) / math.pi
    return bits, max(1, math.ceil(math.log(miss) / math.log1p(-(p**bits))))


def sketch_limit(threshold: float, miss: float = 1e-6) -> int:
    """Largest number of differing sketch signs that a pair at the threshold exceeds with probability ``miss`` at most."""
    q = math.acos(threshold) / math.pi
    beyond, n = 1.0, -1
    while beyond > miss:
        n += 1
        beyond -= math.comb(SKETCH, n) * q**n * (1 - q) ** (SKETCH - n)
    return n


@lru_cache(4)
def _planes(length: int, count: int, seed: int) -> np.ndarray:
    """Whole numbers: with unit rows in steps of 2^-20 every partial sum stays below 2^53 (2^41 a component, 2^12 of them)."""
    return np.rint(np.clip(np.random.default_rng([seed, length]).standard_normal((length, count)), -7.9, 7.9) * (1 << max(0, 17 - max(0, (length - 1).bit_length() - 12))))


def signs_of(unit: np.ndarray, count: int, seed: int) -> np.ndarray:
    return np.rint(unit * (1 << 20)) @ _planes(unit.shape[1], count, seed) > 0


def codes_of(unit: np.ndarray, bits: int, tables: int, seed: int) -> np.ndarray:
    """Sign codes, one column a table."""
    signs = signs_of(unit, tables * bits, seed).reshape(len(unit), tables, bits)
    return signs @ (1 << np.arange(bits, dtype=np.int64))


def sketches_of(unit: np.ndarray, seed: int) -> np.ndarray:
    """SKETCH signs as 64-bit words."""
    return np.packbits(signs_of(unit, SKETCH, seed + 1), axis=1).view(np.uint64)


def has_near(words: np.ndarray, limit: int) -> np.ndarray:
    """Which rows of sketches differ from another row in ``limit`` signs at most."""
    out = np.zeros(len(words), bool)
    for at in range(0, len(words), 256):
        part = words[at : at + 256]
        apart = np.zeros((len(part), len(words)), np.uint16)
        for w in range(words.shape[1]):
            apart += np.bitwise_count(part[:, w, None] ^ words[None, :, w])
        apart[np.arange(len(part)), at + np.arange(len(part))] = SKETCH + 1
        out[at : at + 256] = (apart <= limit).any(axis=1)
    return out


def unit_rows(column: pa.Array) -> np.ndarray:
    """Rows of one length as unit vectors in double precision; scaled first, so no square overflows."""
    rows = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    rows /= np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def near_vectors(vectors: DataFrame, threshold: float = 0.93, seed: int = 23, block_rows: int = 512, sketch_rows: int = 2048) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of vectors(vec_id, embedding, label)."""
    fine = F.col("embedding").isNotNull() & (F.size("embedding") > 0) & F.col("label").isNotNull()
    whole = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists("embedding", lambda x: x != 0)
    rows = vectors.select(F.col("vec_id").cast("bigint"), "embedding", F.col("label").cast("string"))
    plain = F.transform("embedding", lambda x: x + F.lit(0.0))
    own = fine & whole & some
    rows = rows.withColumns({"cid": F.when(own, F.xxhash64("label", plain)), "twin": F.when(own, F.xxhash64(F.lit("twin"), plain, "label"))})
    rows = without_clashes(checkpointed(rows), "cid", "twin")
    classes = checkpointed(rows.where("cid is not null").groupBy("cid").agg(F.count("*").alias("copies"), F.first("embedding").alias("embedding"), F.first("label").alias("label")))
    largest = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    bits, tables = hash_shape(largest, threshold)
    limit = sketch_limit(threshold)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = pc.list_value_length(batch["embedding"]).to_numpy(zero_copy_only=False).astype(np.int64)
            for length in np.unique(lengths).tolist():
                at = np.flatnonzero(lengths == length)
                part = batch.take(pa.array(at))
                unit = unit_rows(part["embedding"])
                codes, sketch = codes_of(unit, bits, tables, seed), pa.array([x.tobytes() for x in sketches_of(unit, seed)], pa.binary())
                for t in range(tables):
                    yield pa.record_batch([part["cid"], part["label"], pa.array(np.full(len(at), length)), pa.array(np.full(len(at), t)), pa.array(codes[:, t]), sketch], ["cid", "label", "length", "t", "code", "sketch"])

    hashed = classes.select("cid", "embedding", "label").mapInArrow(spread, "cid bigint, label string, length bigint, t bigint, code bigint, sketch binary")
    hashed = checkpointed(hashed.select("cid", "t", F.xxhash64("label", "length", "t", "code").alias("bucket"), "sketch"))

    def sieve(runs: Iterator) -> Iterator[pa.RecordBatch]:
        for table, cuts in runs:
            words = np.frombuffer(b"".join(table["sketch"].to_pylist()), np.uint64).reshape(table.num_rows, -1)
            near = np.zeros(table.num_rows, bool)
            for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                near[lo:hi] = has_near(words[lo:hi], limit)
            yield from table.select(["cid", "t", "bucket"]).filter(pa.array(near)).to_batches()

    shared = hashed.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1").select(rekey("bucket"), "size")
    met = in_blocks(hashed.join(shared, "bucket"), "bucket", "size", sketch_rows, "cid").select("task", "cid", "t", "bucket", "sketch")
    likely = checkpointed(by_run(met, "task", sieve, "cid bigint, t bigint, bucket bigint").distinct())
    sizes = likely.groupBy("bucket").agg(F.count("*").alias("size")).select(rekey("bucket"), "size")
    members = likely.join(sizes, "bucket").join(classes.select("cid", "copies", "embedding"), "cid")
    dealt = in_blocks(members, "bucket", "size", block_rows, "cid").select("task", "cid", "copies", "t", "block", "block_lo", "block_hi", "embedding")

    def compare(runs: Iterator) -> Iterator[pa.RecordBatch]:
        for table, cuts in runs:
            ids, weight, at_table, block, low, high = (table[c].to_numpy() for c in ("cid", "copies", "t", "block", "block_lo", "block_hi"))
            vectors = table["embedding"].combine_chunks()
            vectors = vectors.chunk(0) if isinstance(vectors, pa.ChunkedArray) else vectors
            out = {"cid": [], "links": [], "nbr": []}
            for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                if hi - lo < 2:
                    continue
                unit = unit_rows(vectors.slice(lo, hi - lo))
                near = unit @ unit.T >= threshold
                np.fill_diagonal(near, False)
                if not near.any():
                    continue
                own, t = block[lo:hi], int(at_table[lo])
                x, y = np.nonzero(near)
                codes = codes_of(unit, bits, tables, seed)
                counted = ~(codes[x, :t] == codes[y, :t]).any(axis=1)
                a, b = int(low[lo]), int(high[lo])
                if a != b:
                    # a pair inside a block meets again beside every other block: it counts beside the least of them alone
                    counted &= (own[x] != own[y]) | ((own[x] == b) & (a == 0)) | ((own[x] == a) & (a == 0) & (b == 1))
                links = np.bincount(x[counted], weight[lo:hi][y[counted]], hi - lo).astype(np.int64)
                names = ids[lo:hi]
                for i in np.flatnonzero(links).tolist():
                    out["cid"].append(int(names[i]))
                    out["links"].append(int(links[i]))
                    out["nbr"].append(None)
                for i, j in reached(hi - lo, lambda i, left, near=near: near[i, left]):
                    out["cid"].append(int(names[i]))
                    out["links"].append(0)
                    out["nbr"].append(int(names[j]))
            yield pa.record_batch([pa.array(v, pa.int64()) for v in out.values()], list(out))

    found = checkpointed(by_run(dealt, "task", compare, "cid bigint, links bigint, nbr bigint"))
    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    parts = connected_components(found.select(F.col("cid").alias("u"), F.col("nbr").alias("v")))
    per_class = classes.select("cid", "copies").join(links, "cid", "left").join(parts.select(F.col("node").alias("cid"), "component"), "cid", "left")
    per_class = per_class.select(rekey("cid"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "cid").alias("component"))
    merged = checkpointed(rows.select("vec_id", "cid").join(per_class, "cid", "left").select("vec_id", "n_links", "component"))
    first = merged.where("component is not null").groupBy("component").agg(F.min("vec_id").alias("component_id")).select(rekey("component"), "component_id")
    out = merged.join(first, "component", "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.col("component_id").isNull()))
