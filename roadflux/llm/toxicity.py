"""Toxicity by non-negative positive-unlabelled learning (numpy, linear, sparse).

Confirmed toxic texts are the positives; all other training texts count as
unlabelled, their labels unseen.  With class prior p, the risk is
``p * E_pos[l(+)] + max(0, E_unl[l(-)] - p * E_pos[l(-)])``: the second part
estimates the clean texts' loss without clean labels and is kept from going
negative (where it does, the step goes the other way, so the fit gives back
what it overfitted).  l is the logistic loss, the features are hashed distinct
words, and an L1 proximal step keeps the weights few, so scoring a text of any
length is one lookup a word.

The training sample is bounded by ``positives`` and ``unlabelled`` rows (lowest
id hashes first) and by ``total_bytes`` of text, ``longest_bytes`` each; the prior is
counted over all labelled training rows.

Defined cases: null and empty texts score as the intercept alone.  Without a
positive training row every score is the prior.  Repeated rows score alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_texts
from .vectext import chunks, words

BITS = 20
_PUNCTUATION = b".,;:!?\"'()[]{}|*#$%&<>-_/"
_U = np.uint64


def _plain(data: np.ndarray) -> np.ndarray:
    """ASCII punctuation reads as a blank, so a word is the same word before a comma."""
    table = np.arange(256, dtype=np.uint8)
    table[list(_PUNCTUATION)] = 32
    return table[data]


def word_slots(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, text number, slot) of distinct hashed words, in chunks of rows."""
    for lo, hi, data, off in chunks(column):
        h, _, _, per = words(_plain(data), off)
        text = np.repeat(np.arange(hi - lo, dtype=np.int64), np.diff(per))
        both = np.unique((text << BITS) | (h >> _U(64 - BITS)).astype(np.int64))
        yield lo, hi, both >> BITS, both & ((1 << BITS) - 1)


@dataclass
class Linear:
    """Sparse linear scorer: sorted slots with weights, and an intercept."""

    slots: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    bias: float = 0.0

    def score(self, column: pa.Array) -> np.ndarray:
        out = np.full(len(column), self.bias)
        dense = np.zeros(1 << BITS)
        dense[self.slots] = self.weights
        for lo, hi, text, slot in word_slots(column):
            out[lo:hi] += np.bincount(text, dense[slot], hi - lo)
        return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def nnpu_risk(margin: np.ndarray, pos: np.ndarray, prior: float) -> tuple[float, float, np.ndarray]:
    """(positive part, negative part before the cut at 0, direction of descent by margin) of the non-negative risk."""
    n_pos, n_unl = int(pos.sum()), int((~pos).sum())
    p = 1 / (1 + np.exp(-np.clip(margin, -30, 30)))
    loss_neg = np.logaddexp(0, margin)
    clean = loss_neg[~pos].mean() - prior * loss_neg[pos].mean()
    lower = np.where(pos, -prior * p / n_pos, p / n_unl)
    grad = lower + np.where(pos, prior * (p - 1) / n_pos, 0.0) if clean >= 0 else -lower
    return prior * np.logaddexp(0, -margin[pos]).mean(), clean, grad


def fit_nnpu(texts: np.ndarray, slots: np.ndarray, positive: np.ndarray, prior: float, steps: int = 300, rate: float = 0.1, strength: float = 0.3, least: int = 2) -> Linear:
    """Fit on (text, slot) pairs; positive marks the texts known to be positive.

    The L1 penalty is ``strength`` over the number of texts.  Only slots that occur
    in ``least`` positives or more get a weight: others would rest on one text.
    """
    pos = positive.astype(bool)
    frequency = np.bincount(slots[pos[texts]], minlength=1 << BITS)
    known = np.flatnonzero(frequency >= least)
    if not pos.any() or not (~pos).any() or not len(known):
        return Linear(bias=float(np.log(max(prior, 1e-6) / max(1 - prior, 1e-6))))
    at = np.full(1 << BITS, -1)
    at[known] = np.arange(len(known))
    keep = at[slots] >= 0
    texts, columns = texts[keep], at[slots[keep]]
    l1 = strength / len(pos)
    n = len(pos)
    w, bias = np.zeros(len(known)), float(np.log(prior / (1 - prior)))
    first, second = np.zeros(len(known) + 1), np.zeros(len(known) + 1)
    for step in range(1, steps + 1):
        margin = bias + np.bincount(texts, w[columns], n)
        grad = nnpu_risk(margin, pos, prior)[2]
        g = np.concatenate((np.bincount(columns, grad[texts], len(known)), [grad.sum()]))
        first = 0.9 * first + 0.1 * g
        second = 0.999 * second + 0.001 * g * g
        scale = rate / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        move = scale * first / (1 - 0.9**step)
        w = w - move[:-1]
        w = np.sign(w) * np.maximum(np.abs(w) - scale[:-1] * l1, 0)
        bias -= move[-1]
    used = np.flatnonzero(w)
    return Linear(known[used], w[used], float(bias))


def train(docs: DataFrame, labels: DataFrame, learn: Column, positives: int = 4000, unlabelled: int = 12000, total_bytes: int = 1 << 28, longest_bytes: int = 1 << 22) -> Linear:
    """Fit on at most ``positives`` + ``unlabelled`` labelled rows that ``learn`` marks.

    docs(doc_id, text), labels(doc_id, toxic).  A document with several label
    rows is toxic if one of them says so; null labels count as unlabelled.
    """
    known = labels.select("doc_id", F.coalesce(F.col("toxic"), F.lit(0)).alias("toxic")).where(learn & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    total, toxic = known.agg(F.count("*"), F.sum("toxic")).first()
    prior = min(max((toxic or 0) / total, 1e-4), 1 - 1e-4) if total else 0.5
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = known.where("toxic = 1").orderBy(*order).limit(positives).withColumn("pos", F.lit(True))
    # any training row may be drawn as unlabelled: its label is not looked at
    chosen = chosen.unionByName(known.orderBy(F.xxhash64("doc_id", F.lit(1)), "doc_id").limit(unlabelled).withColumn("pos", F.lit(False)))
    picked = bounded_texts(docs, chosen.select("doc_id", "pos"), total_bytes, longest_bytes)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, text, slot in word_slots(batch["text"]):
                ends = np.searchsorted(text, np.arange(1, hi - lo + 1))
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)), pa.int32()), pa.array(slot, pa.int32()))
                yield pa.record_batch([batch["pos"].slice(lo, hi - lo), lists], ["pos", "slots"])

    table = picked.select("pos", "text").mapInArrow(features, "pos boolean, slots array<int>").toArrow().combine_chunks()
    if not table.num_rows:
        return Linear(bias=float(np.log(prior / (1 - prior))))
    lists = table["slots"].combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    slots = lists.flatten().to_numpy().astype(np.int64)
    return fit_nnpu(np.repeat(np.arange(len(sizes)), sizes), slots, table["pos"].to_numpy(), prior)


def scored(docs: DataFrame, model: Linear) -> DataFrame:
    """(doc_id, score) for every row of docs(doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch([batch["row"], pa.array(shared.value.score(batch["text"]))], ["row", "score"])

    kind = dict(docs.dtypes)["doc_id"]
    rows = docs.select(F.struct("doc_id").alias("row"), F.col("text").cast("string"))
    return rows.mapInArrow(run, f"row struct<doc_id:{kind}>, score double").select("row.doc_id", "score")
