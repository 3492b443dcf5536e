"""Walk key-sorted Arrow batches run by run with bounded carry-over."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame


def sorted_runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """(rows, run offsets): whole runs of equal ``key`` only; a run that a batch cuts is carried on."""
    held: list[pa.Table] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(pa.Table.from_batches([batch]))
        if len(held) > 1 and held[0][key][0] == batch[key][-1]:
            continue  # still the run that was carried
        table = pa.concat_tables(held).combine_chunks()
        keys = table[key].to_numpy()
        cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        if not len(cuts):
            held = [table]
            continue
        yield table.slice(0, int(cuts[-1])).combine_chunks(), np.concatenate(([0], cuts))
        held = [table.slice(int(cuts[-1])).combine_chunks()]
    if held:
        table = pa.concat_tables(held).combine_chunks()
        keys = table[key].to_numpy()
        cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        yield table, np.concatenate(([0], cuts, [len(keys)]))


def by_run(df: DataFrame, key: str, function: Callable, schema: str) -> DataFrame:
    """Apply ``function(iterator of (table, offsets))`` to rows gathered and sorted by ``key``."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from function(sorted_runs(batches, key))

    return df.repartition(key).sortWithinPartitions(key).mapInArrow(apply, schema)


def reached(n: int, linked: Callable[[int, np.ndarray], np.ndarray]) -> list[tuple[int, int]]:
    """Spanning forest of a graph given by ``linked(i, others) -> mask``, breadth first.

    A node is compared only with nodes not reached so far, so a tight group of
    m costs about m comparisons, not m * m, and yields m - 1 edges.
    """
    left, edges = np.arange(n), []
    while len(left):
        queue, left = [int(left[0])], left[1:]
        while queue and len(left):
            at = queue.pop(0)
            hit = linked(at, left)
            if hit.any():
                found = left[hit].tolist()
                edges += [(at, x) for x in found]
                queue += found
                left = left[~hit]
    return edges
