import numpy as np
import pytest

from roadflux.llm import embeddings

SCHEMA = "vec_id bigint, embedding array<float>, label int, cid string"


def brute(rows, threshold=0.93):
    ids = [r[0] for r in rows]
    up = {i: i for i in range(len(rows))}
    links = [0] * len(rows)

    def fine(v):
        return v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(rows):
        for j in range(i):
            b = rows[j]
            if a[2] is not None and a[2] == b[2] and fine(a[1]) and fine(b[1]) and len(a[1]) == len(b[1]):
                x, y = (np.asarray(np.asarray(v, np.float32), float) for v in (a[1], b[1]))
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= threshold:
                    links[i] += 1
                    links[j] += 1
                    up[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for i, d in enumerate(ids):
        least[root(i)] = min(least.get(root(i), d), d)
    return sorted((d, links[i], least[root(i)], least[root(i)] == d) for i, d in enumerate(ids))


def data(seed=1):
    rnd = np.random.default_rng(seed)
    rows = []
    for c in range(12):
        centre = rnd.standard_normal(24)
        for _ in range(20):
            rows.append(centre + rnd.standard_normal(24) * rnd.choice([0, 0.05, 0.2, 0.35, 0.5]))
    rows = [(i, v.astype(np.float32).tolist(), int(i % 3), "x") for i, v in enumerate(rows)]
    one = [1.0, 2.0, 0.0]
    odd = [(one, None), (None, 1), ([], 1), ([0.0, 0.0, 0.0], 1), ([1.0, None, 2.0], 1), ([1.0, float("nan"), 2.0], 1), ([1.0, float("inf"), 2.0], 1), (one, 1), (one, 1), ([2.0, 4.0, 0.0], 1), ([1.0, 2.0], 1), ([3e38, 3e38, 0.0], 2), ([-0.0, 1e-40, 0.0], 2), ([0.0, 1e-40, 0.0], 2)]
    return rows + [(1000 + i, v, label, "y") for i, (v, label) in enumerate(odd)]


@pytest.mark.parametrize("rows_a_block", [{}, {"block_rows": 4, "sketch_rows": 6}])
def test_against_brute_force(spark, rows_a_block):
    rows = data()
    got = embeddings.near_vectors(spark.createDataFrame(rows, SCHEMA).repartition(4), **rows_a_block)
    assert sorted(map(tuple, got.collect())) == brute(rows)


def test_repeated_rows_and_nothing(spark):
    rows = [(7, [1.0, 0.0], 1, ""), (7, [1.0, 0.0], 1, ""), (8, [1.0, 0.01], 1, ""), (None, [0.0, 1.0], 1, "")]
    got = embeddings.near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in got) == [(0, 0, None, True), (7, 2, 7, True), (7, 2, 7, True), (8, 2, 7, False)]
    assert embeddings.near_vectors(spark.createDataFrame(rows, SCHEMA).limit(0)).count() == 0


@pytest.mark.parametrize("rows", [1, 500, 20_000, 10**7, 10**10])
def test_misses_are_bounded_at_every_size(rows):
    bits, tables = embeddings.hash_shape(rows, 0.93)
    p = 1 - np.arccos(0.93) / np.pi
    assert (1 - p**bits) ** tables <= 1.01e-6


def test_codes_do_not_depend_on_the_batch():
    unit = np.random.default_rng(4).standard_normal((300, 96))
    unit /= np.sqrt((unit * unit).sum(axis=1, keepdims=True))
    whole, sketch = embeddings.codes_of(unit, 9, 30, 23), embeddings.sketches_of(unit, 23)
    for at in range(0, 300, 7):
        assert (embeddings.codes_of(unit[at : at + 1], 9, 30, 23) == whole[at]).all() and (embeddings.sketches_of(unit[at : at + 3], 23) == sketch[at : at + 3]).all()
    for length in (3, 4096, 5000, 100_000):  # exact in any order: all partial sums below 2^53
        planes = embeddings._planes(length, 2, 23)
        assert (planes == np.rint(planes)).all() and np.abs(planes).max() * 2**20 * length < 2**53


def test_sketches_pass_pairs_at_the_threshold():
    rnd, limit = np.random.default_rng(5), embeddings.sketch_limit(0.93)
    a = rnd.standard_normal((2000, 64))
    a /= np.sqrt((a * a).sum(axis=1, keepdims=True))
    b = rnd.standard_normal((2000, 64))
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b /= np.sqrt((b * b).sum(axis=1, keepdims=True))
    near, far = 0.93 * a + np.sqrt(1 - 0.93**2) * b, b
    apart = lambda x: np.bitwise_count(embeddings.sketches_of(a, 23) ^ embeddings.sketches_of(x, 23)).sum(axis=1)
    assert (apart(near) <= limit).all() and (apart(far) <= limit).mean() < 0.01
    words = embeddings.sketches_of(np.concatenate((a[:300], near[:150])), 23)
    assert embeddings.has_near(words, limit).tolist()[:150] == [True] * 150 and embeddings.has_near(words, limit)[150:300].mean() < 0.05
