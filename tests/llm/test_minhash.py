import random
import re

import numpy as np
import pyarrow as pa
import pytest

from roadflux.llm import minhash, vectext

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UP = str.maketrans({c: c + 32 for c in range(65, 91)})


def shingles(text, k):
    w = WORD.findall((text or "").translate(UP))
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def brute(rows, k, percent):
    sets = [shingles(t, k) for _, t in rows]
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                up[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), d), d)
    return [(d, len(sets[i]), least[root(i)], least[root(i)] == d) for i, (d, _) in enumerate(rows)]


def corpus(seed=3):
    """Variants of a few base texts around the threshold, copies, and texts that only share a passage."""
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = rnd.choices(vocabulary, k=25)
    rows = []
    for base in range(6):
        words = rnd.choices(vocabulary, k=rnd.choice([30, 60, 120]))
        for _ in range(25):
            own = list(words)
            for _ in range(rnd.choice([0, 0, 1, 1, 2, 3, 4, 8])):
                own[rnd.randrange(len(own))] = rnd.choice(vocabulary)
            rows.append(" ".join(own))
    rows += [" ".join(passage + rnd.choices(vocabulary, k=rnd.randint(1, 40))) for _ in range(40)]
    rows += ["", None, "one", "one  two", "ONE two", "a b c", "A b c\n", "\t \n", "é É", "É é"]
    rnd.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize(("k", "options"), [(4, {}), (5, {"bucket_rows": 6, "block_shingles": 200})], ids=["whole buckets", "block pairs"])
def test_against_brute_force(spark, k, options):
    rows = corpus()
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5), k=k, percent=80, **options)
    assert sorted(map(tuple, got.collect())) == sorted(brute(rows, k, 80))


def test_a_star_of_variants_is_one_component(spark):
    """Every variant is near the base only: wherever the base stands, nothing may be lost."""
    rnd = random.Random(5)
    words = [f"b{i}" for i in range(60)]
    rows = []
    for v in range(120):
        own = list(words)
        at = rnd.randrange(57)
        own[at], own[at + 1] = f"x{v}", f"y{v}"
        rows.append((v, " ".join(own)))
    rows.insert(70, (500, " ".join(words)))
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), k=4, bucket_rows=16, block_shingles=500)
    assert sorted(map(tuple, got.collect())) == sorted(brute(rows, 4, 80))


def test_defined_cases(spark):
    rows = [(1, "a b c d e f g", 9), (1, "a b c d e f g", 9), (None, "a b c d e f g", 8), (3, None, 1), (3, "", 1), (4, "z z z z z z", 1), (None, "only here at all now", 1)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, component_id int")
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(df).collect())
    assert got == [(False, 1, 3, 1, True)] * 2 + [(False, 3, 0, 3, True)] * 2 + [(False, 4, 1, 4, True), (True, 0, 1, None, True), (True, 0, 3, 1, False)]
    assert minhash.near_duplicates(df.limit(0)).count() == 0
    kept = minhash.deduplicated(df)
    assert kept.columns == df.columns and sorted(r.text or "" for r in kept.collect()) == ["", "", "a b c d e f g", "only here at all now", "z z z z z z"]


def test_one_row_of_every_group_stays(spark):
    rows = corpus(8)
    df = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id bigint, text string, _key string")
    kept = {r.doc_id for r in minhash.deduplicated(df, k=5).collect()}
    assert kept == {d for d, _, c, own in brute(rows, 5, 80) if own}


def test_groups_without_ids(spark):
    """Rows of null ids are linked as others are, and one row of their group stays."""
    words = [f"w{i}" for i in range(60)]
    near = lambda i: " ".join([*words[:i], "other", *words[i + 1 :]])
    rows = [(None, near(59)), (None, near(59)), (None, near(0)), (None, " ".join(words)), (None, "quite another text of its own"), (7, "x y z u v w"), (None, "x y z u v w")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = minhash.near_duplicates(df.repartition(3)).collect()
    assert sorted((r.component_id or 0, r.n_shingles, r.kept) for r in got if r.n_shingles < 50) == [(0, 2, True), (7, 2, False), (7, 2, True)]
    assert {r.component_id for r in got if r.n_shingles > 50} == {None} and sum(r.kept for r in got if r.n_shingles > 50) in (1, 2)  # 2: the exact copies
    kept = [(r.doc_id, r.text) for r in minhash.deduplicated(df.repartition(3)).collect()]
    assert len(kept) == 3 and {(7, "x y z u v w"), (None, "quite another text of its own")} < set(kept)


def test_very_long_text(spark):
    rnd = random.Random(0)
    words = [f"word{rnd.randrange(5000)}" for _ in range(250_000)]
    rows = [(1, " ".join(words)), (2, " ".join([*words[:-100], "other", *words[-100:]])), (3, "q" * 3_000_000)]
    got = {r.doc_id: r for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got[2].component_id == 1 and got[3].component_id == 3 and got[3].n_shingles == 1
    assert got[1].n_shingles == len(shingles(rows[0][1], 5))


def test_copies_of_a_large_group_are_bounded(spark):
    """Blocks of a large group grow, so that a row is copied 16 times at most, until blocks are as large as they may be."""
    for size, most, low, high in ((1000, 10**6, 1, 1), (4000, 10**6, 7, 8), (200_000, 10**6, 15, 16), (10**8, 10**6, 190, 200)):
        df = spark.range(100).selectExpr("id AS cid", "1L AS component", f"{size}L AS size")
        tasks = minhash.in_blocks(df, "component", "size", 1000, "cid", most).groupBy("cid").count().agg({"count": "max"}).first()[0]
        assert low <= tasks <= high


def test_very_long_words_differ(spark):
    """Words of several thousand bytes, as in scripts without blanks, that hold the same blocks in another order."""
    rows = [(1, "ab" * 2048 + "cd" * 2048), (2, "cd" * 2048 + "ab" * 2048), (3, "ab" * 2048 + "cd" * 2048), (4, "ab" * 2048 + "cd" * 2049), (5, "x" * 4096 + "y" + "x" * 4095), (6, "y" + "x" * 8191)]
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == {1: 1, 2: 2, 3: 1, 4: 4, 5: 5, 6: 6}


def test_classes_agree_in_both_digests(spark, monkeypatch):
    """Digests of very few bits clash all the time: nothing but the second digest keeps the sets apart."""
    rows = corpus(4)
    real = minhash.class_id
    monkeypatch.setattr(minhash, "class_id", lambda s, salt=0: real(s, salt) % 5 if salt != minhash.SECOND else real(s, salt))
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3), k=4)
    assert sorted(map(tuple, got.collect())) == sorted(brute(rows, 4, 80))


def test_word_primitives(monkeypatch):
    texts = ["Ab cd", None, "", "  x ", "tail\n", "ümlaut Ümlaut", "a" * 50, "b c " * 30]
    whole = [vectext.words(d, o) for _, _, d, o in vectext.chunks(pa.array(texts))]
    h, s, e, per = whole[0]
    flat = "".join(t or "" for t in texts).encode()
    assert [flat[a:b].decode() for a, b in zip(s, e, strict=True)] == [w for t in texts for w in WORD.findall(t or "")]
    assert np.diff(per).tolist() == [len(WORD.findall(t or "")) for t in texts]
    monkeypatch.setattr(vectext, "SEGMENT", 7)  # cut anywhere: the same words and hashes
    small = np.concatenate([vectext.words(d, o)[0] for _, _, d, o in vectext.chunks(pa.array(texts), 5)])
    assert (small == h).all()
    assert vectext.words(*vectext.buffer_of(pa.array([], pa.string())))[0].size == 0
