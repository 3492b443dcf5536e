"""Document quality by attention-based multiple-instance learning (numpy).

A document is a bag of passages of at most ``WORDS`` words.  Every passage is
encoded - shares of character kinds, word lengths, repetition inside the
passage and against the passage before it, hashed word marks - by a tanh layer;
gated attention ``softmax(w . (tanh(V h) * sigmoid(U h)))`` weighs the passages
and a logistic unit scores the weighted sum.  Attention and scorer are learnt
together from document labels by hand-written gradients (Adam).

The training sample is bounded by ``bound`` labelled rows (lowest id hashes
first) and by ``total_bytes`` of text, ``longest_bytes`` each; features are standardised on it.

Defined cases: null, empty and word-less texts are one all-zero passage.
With fewer than two classes to learn from, every score is the share of label 1.
Repeated rows score alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import bounded_texts
from .vectext import chunks, words

WORDS, MARKS = 64, 16
_KINDS = [b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b".,;:", b"!?", b"#$%&*@^~=+", b"|<>/\\_{}[]", b"\n", b"'\"()-"]
STATS = len(_KINDS) + 1 + 8
_U = np.uint64


def passages(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, features of passages, passages per row), in chunks of rows."""
    kind_of = np.full(256, len(_KINDS) + 1, np.uint8)
    kind_of[128:] = len(_KINDS)
    for i, members in enumerate(_KINDS):
        kind_of[list(members)] = i
    for lo, hi, data, off in chunks(column):
        h, start, end, per = words(data, off)
        counts = np.diff(per)
        bags = np.maximum(1, -(-counts // WORDS))
        features = np.zeros((int(bags.sum()), STATS + MARKS), np.float32)
        if len(h):
            text = np.repeat(np.arange(hi - lo), counts)
            place = np.arange(len(h)) - per[:-1][text]
            bag_at = np.cumsum(bags) - bags
            own = bag_at[text] + place // WORDS
            first = np.flatnonzero(place % WORDS == 0)
            rows, n = own[first], np.diff(np.append(first, len(h))).astype(np.float64)
            length = np.add.reduceat(end - start, first).astype(np.float64)
            # bytes up to the next passage of the same text, so white space is seen too
            tail = np.append(first[1:], len(h))
            upto = np.where(np.append(text[first[1:]], -1) == text[first], np.append(start[first[1:]], 0), off[text[first] + 1])
            kinds = kind_of[data]
            for k in range(len(_KINDS) + 1):
                sums = np.concatenate(([0], np.cumsum(kinds == k, dtype=np.int64)))
                features[rows, k] = (sums[upto] - sums[start[first]]) / np.maximum(upto - start[first], 1)
            at = len(_KINDS) + 1
            same = lambda gap: np.concatenate((np.zeros(min(gap, len(h)), bool), (h[gap:] == h[:-gap]) & (text[gap:] == text[:-gap])))
            pair = np.sort((own.astype(_U) << _U(40)) ^ (h >> _U(24)))
            distinct = np.concatenate(([True], pair[1:] != pair[:-1]))
            uniq = np.bincount((pair[distinct] >> _U(40)).astype(np.int64), minlength=len(features))[rows]
            again = np.zeros(len(h), bool)  # seen before in the whole text
            order = np.lexsort((np.arange(len(h)), h, text))
            again[order[1:]] = (h[order[1:]] == h[order[:-1]]) & (text[order[1:]] == text[order[:-1]])
            shift = np.concatenate((h[1:], np.zeros(1, _U)))
            two = h * _U(3) ^ shift
            order = np.lexsort((two, text))
            pair_again = np.zeros(len(h), bool)
            pair_again[order[1:]] = (two[order[1:]] == two[order[:-1]]) & (text[order[1:]] == text[order[:-1]])
            size = (end - start).astype(np.float64)
            columns = [uniq / n, np.add.reduceat(same(1), first, dtype=np.int64) / n, np.add.reduceat(again, first, dtype=np.int64) / n, np.add.reduceat(pair_again, first, dtype=np.int64) / n]
            mean = length / n
            columns += [mean / 8, np.sqrt(np.maximum(np.add.reduceat(size * size, first) / n - mean * mean, 0)) / 8, np.log1p(n) / 4, np.maximum.reduceat(size, first) / 32]
            for i, values in enumerate(columns):
                features[rows, at + i] = np.minimum(values, 8)
            mark = (h >> _U(60)).astype(np.int64)
            features[:, STATS:] = np.bincount(own * MARKS + mark, minlength=len(features) * MARKS).reshape(-1, MARKS) / np.maximum(np.bincount(own, minlength=len(features)), 1)[:, None]
        yield lo, hi, features, bags


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class AttentionMil:
    """Gated-attention bag classifier."""

    def __init__(self, inputs: int, hidden: int = 24, gate: int = 16, seed: int = 5) -> None:
        rng = np.random.default_rng(seed)
        scale = lambda a, b: rng.normal(0, 1 / np.sqrt(a), (a, b))
        self.mean, self.std, self.constant = np.zeros(inputs), np.ones(inputs), None
        self.w = {"E": scale(inputs, hidden), "e": np.zeros(hidden), "V": scale(hidden, gate), "U": scale(hidden, gate), "a": scale(gate, 1)[:, 0], "c": scale(hidden, 1)[:, 0], "d": np.zeros(1)}

    def forward(self, features: np.ndarray, bags: np.ndarray) -> dict[str, np.ndarray]:
        w, x = self.w, np.clip((features - self.mean) / self.std, -6, 6)
        first, bag = np.cumsum(bags) - bags, np.repeat(np.arange(len(bags)), bags)
        h = np.tanh(x @ w["E"] + w["e"])
        t, s = np.tanh(h @ w["V"]), _sigmoid(h @ w["U"])
        logit = (t * s) @ w["a"]
        weight = np.exp(logit - np.maximum.reduceat(logit, first)[bag])
        weight /= np.add.reduceat(weight, first)[bag]
        z = np.add.reduceat(weight[:, None] * h, first, axis=0)
        return {"x": x, "h": h, "t": t, "s": s, "weight": weight, "z": z, "bag": bag, "first": first, "p": _sigmoid(z @ w["c"] + w["d"][0])}

    def gradients(self, f: dict[str, np.ndarray], labels: np.ndarray, importance: np.ndarray) -> dict[str, np.ndarray]:
        w, bag, weight = self.w, f["bag"], f["weight"]
        dout = (f["p"] - labels) * importance
        dz = dout[:, None] * w["c"]
        dweight = (dz[bag] * f["h"]).sum(axis=1)
        dlogit = weight * (dweight - np.add.reduceat(weight * dweight, f["first"])[bag])
        dt, ds = dlogit[:, None] * w["a"] * f["s"] * (1 - f["t"] ** 2), dlogit[:, None] * w["a"] * f["t"] * f["s"] * (1 - f["s"])
        dh = (weight[:, None] * dz[bag] + dt @ w["V"].T + ds @ w["U"].T) * (1 - f["h"] ** 2)
        return {"E": f["x"].T @ dh, "e": dh.sum(axis=0), "V": f["h"].T @ dt, "U": f["h"].T @ ds, "a": (f["t"] * f["s"]).T @ dlogit, "c": f["z"].T @ dout, "d": np.array([dout.sum()])}

    def fit(self, features: np.ndarray, bags: np.ndarray, labels: np.ndarray, epochs: int = 30, batch: int = 128, rate: float = 4e-3, decay: float = 1e-4, seed: int = 9) -> AttentionMil:
        share = float(labels.mean()) if len(labels) else 0.5
        if share in (0.0, 1.0) or not len(labels):
            self.constant = share
            return self
        self.mean, self.std = features.mean(axis=0), features.std(axis=0) + 1e-3
        rng, first = np.random.default_rng(seed), np.cumsum(bags) - bags
        m, v, step = {k: np.zeros_like(x) for k, x in self.w.items()}, {k: np.zeros_like(x) for k, x in self.w.items()}, 0
        for epoch in range(epochs):
            order = rng.permutation(len(bags))
            for at in range(0, len(order), batch):
                own = order[at : at + batch]
                rows = np.repeat(first[own] - (np.cumsum(bags[own]) - bags[own]), bags[own]) + np.arange(bags[own].sum())
                g = self.gradients(self.forward(features[rows], bags[own]), labels[own], np.full(len(own), 1 / len(own)))
                step += 1
                pace = rate * (1 - epoch / epochs)
                for k, x in self.w.items():
                    g[k] = g[k] + decay * x
                    m[k] = 0.9 * m[k] + 0.1 * g[k]
                    v[k] = 0.999 * v[k] + 0.001 * g[k] ** 2
                    x -= pace * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
        return self

    def score(self, column: pa.Array) -> np.ndarray:
        out = np.full(len(column), 0.0 if self.constant is None else self.constant)
        if self.constant is None:
            for lo, hi, features, bags in passages(column):
                out[lo:hi] = np.round(self.forward(features, bags)["p"], 9)  # beyond that, the order of summing shows
        return out


def train(docs: DataFrame, labels: DataFrame, learn: Column, bound: int = 6000, total_bytes: int = 1 << 28, longest_bytes: int = 1 << 22) -> AttentionMil:
    """Fit on at most ``bound`` labelled rows that ``learn`` marks; docs(doc_id, text), labels(doc_id, quality).

    Rows with a null quality are not learnt from; several label rows of one
    document count as their maximum.
    """
    known = labels.select("doc_id", "quality").where(learn & F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
    known = known.groupBy("doc_id").agg(F.max("quality").alias("quality"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
    picked = bounded_texts(docs, chosen, total_bytes, longest_bytes)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, found, bags in passages(batch["text"]):
                ends = np.cumsum(bags)
                blobs = [found[e - b : e].tobytes() for e, b in zip(ends, bags, strict=True)]
                yield pa.record_batch([batch["doc_id"].slice(lo, hi - lo).cast(pa.int64()), batch["quality"].slice(lo, hi - lo).cast(pa.int32()), pa.array(blobs, pa.binary())], ["doc_id", "quality", "bag"])

    table = picked.select("doc_id", "quality", "text").mapInArrow(features, "doc_id bigint, quality int, bag binary").toArrow().sort_by("doc_id")
    blobs = table["bag"].to_pylist()
    width = STATS + MARKS
    bags = np.array([len(b) // (4 * width) for b in blobs], np.int64)
    found = np.frombuffer(b"".join(blobs), np.float32).reshape(-1, width)
    return AttentionMil(width).fit(found, bags, table["quality"].to_numpy().astype(np.float64))


def scored(docs: DataFrame, model: AttentionMil) -> DataFrame:
    """(doc_id, score) for every row of docs(doc_id, text)."""
    return with_score(docs, model, ["doc_id"])


def with_score(docs: DataFrame, model: AttentionMil, keep: list[str]) -> DataFrame:
    """keep + score; the kept columns travel untouched beside the text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch([batch["_row"], pa.array(shared.value.score(batch["_text"]))], ["_row", "_score"])

    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_row"), F.col("text").cast("string").alias("_text"))
    out = rows.mapInArrow(run, StructType([rows.schema["_row"], StructField("_score", DoubleType())]))
    return out.select(*[F.col(f"_row.`{c}`").alias(c) for c in keep], F.col("_score").alias("score"))
