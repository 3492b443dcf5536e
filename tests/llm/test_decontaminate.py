import random

import pytest

from roadflux.llm import decontaminate as dc


def least(pattern, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        last, row[0] = row[0], i
        for j, d in enumerate(text, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (c != d))
    return min(row), row.index(min(row))


def test_myers():
    rnd = random.Random(1)
    for _ in range(600):
        p = "".join(rnd.choices("abc ", k=rnd.randint(1, 80)))
        t = "".join(rnd.choices("abc ", k=rnd.randint(0, 90)))
        want, budget = least(p, t), rnd.randint(0, len(p) - 1)
        assert dc.Myers(p).best(t, budget) == (want if want[0] <= budget else None)


@pytest.mark.parametrize("rate", [0.0, 0.05, 0.08, 0.15])
def test_no_occurrence_within_the_budget_is_missed(rate):
    rnd = random.Random(7)
    for _ in range(150):
        items = [(i, "".join(rnd.choices("ab ", k=rnd.randint(12, 70)))) for i in range(4)]
        own = list(rnd.choice(items)[1])
        for _ in range(rnd.randint(0, 6)):
            at = rnd.randrange(len(own))
            own[at : at + 1] = rnd.choice(["", "c", "ab"])
            own = own or ["a"]
        text = "".join(rnd.choices("ab ", k=40)) + "".join(own) + "".join(rnd.choices("ab ", k=40))
        want = {(i, least(p, text)[0]) for i, p in items if least(p, text)[0] <= int(len(p) * rate)}
        assert {(i, d) for i, d, _ in dc.Matcher(items, rate).matches(text)} == want


def test_repetitive_items_with_edited_openings():
    """Equal pieces at several offsets: the true alignment may be that of a later hit with an earlier begin."""
    rnd = random.Random(11)
    item = "is a a subset of b is b a subset of c is c a subset of d is a a subset of d answer yes or no"
    items = [(0, item), (1, "one two three four " * 5 + "and so on to the very end of all"), (2, "abcabcab" * 9)]
    for _ in range(400):
        i, pattern = rnd.choice(items)
        own = list(pattern)
        for _ in range(int(len(pattern) * 0.08)):
            own[rnd.randrange(len(own) // 2)] = "q"
        text = "some words before it " + "".join(own) + rnd.choice(["", " and after", " " + item[30:]])
        want = {(i, *least(p, text)) for i, p in items if least(p, text)[0] <= int(len(p) * 0.08)}
        assert want and set(dc.Matcher(items, 0.08).matches(text)) == want


def test_pieces_cover_the_item():
    for n in (1, 10, 99):
        item = "x" * n
        budget, pieces = dc.cut(item, 0.1)
        assert len(pieces) == budget + 1 and "".join(p for _, p in pieces) == item and all(p for _, p in pieces)


ITEM = "What is the capital of the kingdom of Wessex in the year nine hundred?"


def rows(spark):
    noise = "Filler words that say nothing at all, again and again. " * 20
    docs = [
        (1, noise + ITEM + noise, 0), (2, noise + ITEM.upper().replace(" ", "\n") + noise, 0), (3, noise + ITEM.replace("Wessex", "Wesex").replace("year", "yaer") + noise, 0),
        (4, noise, 0), (5, None, 0), (6, "", 0), (None, ITEM, 0), (1, noise + ITEM + noise, 0), (7, "What is the capital of Spain in the year one thousand?", 0), (8, noise * 3000 + ITEM, 0),
    ]
    bench = [(10, ITEM), (11, "short one"), (12, None), (13, ""), (10, ITEM), (14, "?!" * 40)]
    return spark.createDataFrame(docs, "doc_id bigint, text string, item_id int"), spark.createDataFrame(bench, "item_id bigint, text string")


@pytest.mark.parametrize("block_chars", [4_000_000, 60])
def test_documents(spark, block_chars):
    docs, bench = rows(spark)
    got = sorted((r.doc_id or 0, r.item_id, r.distance) for r in dc.contaminated(docs, bench, block_chars=block_chars).collect())
    assert got == sorted(2 * [(0, 10, 0), (1, 10, 0), (1, 10, 0), (2, 10, 0), (3, 10, 3), (8, 10, 0)])  # the item is there twice
    kept = dc.clean(docs, bench, block_chars=block_chars)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [4, 5, 6, 7]


def test_short_items_match_exactly_and_as_whole_words(spark):
    bench = spark.createDataFrame([(1, "What is 2 + 2?"), (2, "art"), (3, "?!"), (4, None)], "item_id bigint, text string")
    texts = ["so: WHAT is 2+2", "what is 2 2", "what was 2 2", "what is 2 25", "parts of a start, art", "parts", "art for art", "art", None, "!?"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = sorted(map(tuple, dc.contaminated(docs, bench).collect()))
    assert got == [(0, 1, 0, 14), (1, 1, 0, 11), (4, 2, 0, 20), (6, 2, 0, 3), (7, 2, 0, 3)]
    assert sorted(r.doc_id for r in dc.clean(docs, bench).collect()) == [2, 3, 5, 8, 9]


def test_empty_tables(spark):
    docs, bench = rows(spark)
    assert dc.contaminated(docs.limit(0), bench).count() == 0 and dc.clean(docs.limit(0), bench).count() == 0
    assert dc.contaminated(docs, bench.limit(0)).count() == 0 and dc.clean(docs, bench.limit(0)).count() == 10
