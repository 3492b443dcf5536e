import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from roadflux.llm import langid, quality, toxicity, vectext
from roadflux.llm.common import bounded_texts

WORDS = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in ("n", "ra", "sto", "li")]


def documents(spark, n=500, seed=1):
    """Toxic texts hold one of a few words, bad ones are shouted or repeat themselves."""
    rnd, docs, labels = random.Random(seed), [], []
    for i in range(n):
        words = rnd.choices(WORDS, k=rnd.randint(20, 200))
        toxic, good = rnd.random() < 0.2, rnd.random() < 0.7
        if toxic:
            words.insert(rnd.randrange(len(words)), rnd.choice(["Vile", "nasty,", "awful."]))
        if not good:
            words = [w.upper() + "!!" for w in words] if rnd.random() < 0.5 else [w for w in words[:6] for _ in range(12)]
        docs.append((i, " ".join(words), i))
        labels.append((i, int(good), int(toxic)))
    docs += [(n, None, 0), (n + 1, "", 0), (None, "plain text", 0), (5, docs[5][1], 0), (n + 2, "bana " * 60_000, 0)]
    labels += [(None, 1, 1), (n, None, None), (6, labels[6][1], labels[6][2])]
    return spark.createDataFrame(docs, "doc_id bigint, text string, score int"), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def accuracy(rows, labels, column, cut):
    truth = {r.doc_id: r[column] for r in labels.collect() if r.doc_id is not None and r[column] is not None}
    held = [(r.score >= cut) == (truth[r.doc_id] == 1) for r in rows if r.doc_id in truth and r.doc_id % 4 == 0]
    return sum(held) / len(held)


@pytest.mark.parametrize(("module", "column", "cut"), [(toxicity, "toxic", 0.5), (quality, "quality", 0.3)])
def test_held_out_accuracy_and_defined_cases(spark, module, column, cut):
    docs, labels = documents(spark)
    model = module.train(docs, labels, F.col("doc_id") % 4 != 0)
    rows = module.scored(docs, model).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert accuracy(rows, labels, column, cut) >= 0.95
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, set()).add(r.score)
    assert all(len(v) == 1 for v in by_id.values())  # rows repeated score alike
    assert module.scored(docs.limit(0), model).count() == 0
    nothing = module.train(docs, labels.limit(0), F.lit(True))
    assert len({r.score for r in module.scored(docs, nothing).collect()}) == 1


def test_labels_outside_the_training_rows_change_nothing(spark):
    docs, labels = documents(spark, 200)
    learn = F.col("doc_id") % 4 != 0
    other = labels.withColumns({c: F.when(learn, F.col(c)).otherwise(1 - F.col(c)) for c in ("quality", "toxic")})
    for module in (toxicity, quality):
        a, b = (module.scored(docs, module.train(docs, x, learn)).orderBy("doc_id", "score").collect() for x in (labels, other))
        assert a == b


def test_non_negative_risk_does_not_sink_on_hidden_positives():
    """Half of the unlabelled texts that hold the word are positive too: their scores stay high."""
    rnd = np.random.default_rng(0)
    texts, slots, positive = [], [], np.zeros(600, bool)
    positive[:100] = True
    for i in range(600):
        own = set(rnd.integers(10, 200, 20).tolist())
        if i < 160:  # 60 of them unlabelled
            own.add(3)
        texts += [i] * len(own)
        slots += sorted(own)
    model = toxicity.fit_nnpu(np.array(texts), np.array(slots), positive, prior=0.15)
    weights = dict(zip(model.slots.tolist(), model.weights.tolist(), strict=True))
    assert weights[3] + model.bias > 0 and model.bias < 0
    assert all(abs(v) < weights[3] / 2 for k, v in weights.items() if k != 3)


def test_risk_against_a_plain_form():
    import math

    rnd = np.random.default_rng(8)
    for shift in (-3.0, 0.0, 3.0):
        margin, pos, prior = rnd.standard_normal(12) + shift, np.arange(12) < 5, 0.3
        margin[:5] += 2 * (shift < 0)

        def plain(m):
            plus = [math.log(1 + math.exp(-x)) for x in m[:5]]
            minus = [math.log(1 + math.exp(x)) for x in m]
            return prior * sum(plus) / 5, sum(minus[5:]) / 7 - prior * sum(minus[:5]) / 5

        up, down, grad = toxicity.nnpu_risk(margin, pos, prior)
        assert (up, down) == pytest.approx(plain(margin))
        for i in range(12):
            step = margin.copy()
            step[i] += 1e-6
            a, b = plain(step)
            want = (a - up) + (b - down) if down >= 0 else -(b - down)
            assert grad[i] == pytest.approx(want / 1e-6, abs=1e-4)
    assert toxicity.nnpu_risk(np.array([5.0, 5.0, -9.0, -9.0]), np.array([True, True, False, False]), 0.3)[1] < 0  # the cut is met


def test_sample_is_bounded_and_one_text_an_id(spark):
    rows = [(i, "word " * 20 + str(i)) for i in range(50)] + [(1, "a smaller text")] * 3 + [(2, "x" * 500)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    chosen = spark.createDataFrame([(i, True) for i in range(60)], "doc_id bigint, pos boolean")
    got = bounded_texts(docs, chosen, 10**6, 10**6).collect()
    assert len(got) == 50 and {r.doc_id: r.text for r in got}[1] == "a smaller text"
    assert sum(len(r.text) for r in bounded_texts(docs, chosen, 1000, 10**6).collect()) <= 1000
    assert len(bounded_texts(docs.where("doc_id = 2 and length(text) = 500"), chosen, 1000, 400).collect()) == 0


def plain_passages(text):
    """The features of a document's passages, word by word."""
    raw = (text or "").encode()
    found = [(m.group(), m.start(), m.end()) for m in re.finditer(rb"[^\x20\x09-\x0d]+", raw)]
    fold = [w.translate(bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))) for w, _, _ in found]
    hashes = {w: int(vectext.words(np.frombuffer(w, np.uint8), np.array([0, len(w)]))[0][0]) for w in set(fold)}
    seen, pairs, out = set(), set(), []
    for at in range(0, max(len(found), 1), quality.WORDS):
        part = range(at, min(at + quality.WORDS, len(found)))
        row = [0.0] * (quality.STATS + quality.MARKS)
        if part:
            stop = found[at + quality.WORDS][1] if at + quality.WORDS < len(found) else len(raw)
            body = raw[found[at][1] : stop]
            kind = lambda c: next((i for i, m in enumerate(quality._KINDS) if c in m), len(quality._KINDS) if c > 127 else -1)
            for c in body:
                if kind(c) >= 0:
                    row[kind(c)] += 1 / len(body)
            n, sizes = len(part), [found[i][2] - found[i][1] for i in part]
            again = two = 0
            for i in part:
                again += fold[i] in seen
                seen.add(fold[i])
                two += (fold[i], fold[i + 1] if i + 1 < len(fold) else None) in pairs
                pairs.add((fold[i], fold[i + 1] if i + 1 < len(fold) else None))
            mean = sum(sizes) / n
            follows = sum(i > 0 and fold[i] == fold[i - 1] for i in part)
            stats = [len({fold[i] for i in part}) / n, follows / n, again / n, two / n, mean / 8, (sum(x * x for x in sizes) / n - mean * mean) ** 0.5 / 8, np.log1p(n) / 4, max(sizes) / 32]
            row[len(quality._KINDS) + 1 : quality.STATS] = [min(x, 8) for x in stats]
            for i in part:
                row[quality.STATS + (hashes[fold[i]] >> 60)] += 1 / n
        out.append(row)
    return np.array(out)


def plain_attention(model, rows):
    w = model.w
    h = [np.tanh(np.clip((x - model.mean) / model.std, -6, 6) @ w["E"] + w["e"]) for x in rows]
    logit = np.array([sum(a * np.tanh(v @ x) / (1 + np.exp(-(u @ x))) for a, v, u in zip(w["a"], w["V"].T, w["U"].T, strict=True)) for x in h])
    weight = np.exp(logit) / np.exp(logit).sum()
    return 1 / (1 + np.exp(-(sum(a * x for a, x in zip(weight, h, strict=True)) @ w["c"] + w["d"][0])))


def test_scores_against_a_plain_forward_pass(spark):
    docs, labels = documents(spark, 200)
    model = quality.train(docs, labels, F.lit(True))
    texts = [r.text for r in docs.limit(60).collect()] + [None, "", "The the THE cat, cat!\n" * 70, "é è " * 65, "word " * 64, "a b " * 64 + "c"]
    got = model.score(pa.array(texts, pa.string()))
    for text, score in zip(texts, got, strict=True):
        rows = plain_passages(text)
        np.testing.assert_allclose(next(quality.passages(pa.array([text], pa.string())))[2], rows, atol=2e-5)
        assert score == pytest.approx(plain_attention(model, rows), abs=1e-4)


def test_attention_gradients():
    rnd = np.random.default_rng(3)
    model = quality.AttentionMil(6, 5, 4)
    x, bags, y = rnd.standard_normal((9, 6)), np.array([2, 3, 1, 3]), np.array([1.0, 0, 1, 0])

    def loss():
        p = model.forward(x, bags)["p"]
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).sum()

    grads = model.gradients(model.forward(x, bags), y, np.ones(4))
    for name, w in model.w.items():
        for at in list(np.ndindex(w.shape))[:6]:
            old = w[at]
            w[at] = old + 1e-5
            up = loss()
            w[at] = old - 1e-5
            down = loss()
            w[at] = old
            assert grads[name][at] == pytest.approx((up - down) / 2e-5, abs=1e-5)


def test_passages_do_not_depend_on_neighbours():
    texts = ["One two three. " * 50, "", None, "SHOUT!! " * 130, "a | b | c\n" * 20]
    together = [f for _, _, f, b in quality.passages(pa.array(texts)) for f in np.split(f, np.cumsum(b)[:-1])]
    for text, whole in zip(texts, together, strict=True):
        alone = next(quality.passages(pa.array([text], pa.string())))[2]
        np.testing.assert_allclose(alone, whole, atol=1e-6)
    assert together[1].shape == (1, quality.STATS + quality.MARKS) and not together[1].any()


def language_rows(seed=2, n=300):
    rnd = random.Random(seed)
    parts = {"aa": ["the", "ing", "tion", "er", "wh"], "bb": ["ção", "lh", "ão", "que", "os"], "cc": ["ung", "sch", "keit", "über", "ß"]}
    rows = []
    for i in range(n):
        lang = rnd.choice(sorted(parts))
        text = " ".join("".join(rnd.choices(parts[lang], k=rnd.randint(1, 4))) for _ in range(rnd.randint(4, 60)))
        rows.append((i, text, lang))
    return rows


def test_languages(spark):
    rows = [*language_rows(n=1500), (9000, None, "aa"), (9001, "", None), (9002, "12 + 3 = 15 !!", "aa"), (9003, "The TION wher", None), (9004, "дом стоит на горе и ждет гостей каждый день " * 3, None), (0, language_rows(n=1500)[0][1], "aa"), (None, "theing tioner", "aa")]
    df = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id bigint, text string, lang string, score double")
    got = {r.doc_id: r for r in langid.identify(df.repartition(3), F.coalesce(F.col("doc_id"), F.lit(0)) % 4 != 2, ["doc_id"]).collect()}
    held = [(got[i].lang_pred == lang) for i, _, lang in language_rows(n=1500) if i % 4 == 2]
    assert sum(held) / len(held) >= 0.95
    for i in (9000, 9001, 9002):
        assert (got[i].lang_pred, got[i].score, got[i].rejected) == ("und", 0.0, True)
    assert got[9003].lang_pred == "aa" and got[9004].rejected and sum(got[i].rejected for i in range(1500)) <= 3
    assert all(0 <= r.score <= 1 for r in got.values())
    assert langid.identify(df.limit(0), F.lit(True), ["doc_id"]).count() == 0
    assert {r.lang_pred for r in langid.identify(df, F.lit(False), ["doc_id"]).collect()} == {"und"}


def plain_kneser_ney(texts, order):
    """Textbook interpolated Kneser-Ney over tuples of characters."""
    from collections import Counter, defaultdict

    top = Counter()
    for text in texts:
        code = [0] * (order - 1) + langid.folded(text).tolist()
        for i in range(order, len(code)):  # ending at every character but the leading blank
            top[tuple(code[i - order + 1 : i + 1])] += 1
    levels = [top]
    for _ in range(order - 1):
        below = Counter()
        for g in levels[0]:
            below[g[1:]] += 1
        levels.insert(0, below)
    alphabet = len({g[-1] for g in top}) + 1

    def p(g):
        if not g:
            return 1 / alphabet
        counts = levels[len(g) - 1]
        ones, twos = sum(c == 1 for c in counts.values()), sum(c == 2 for c in counts.values())
        cut = ones / (ones + 2 * twos) if ones and twos else 0.5
        own = {h: c for h, c in counts.items() if h[:-1] == g[:-1]}
        if not own:
            return p(g[1:])
        total = sum(own.values())
        return max(counts.get(g, 0) - cut, 0) / total + cut * len(own) / total * p(g[1:])

    assert defaultdict
    return p


def test_model_equals_textbook(spark):
    texts = ["abracadabra abra", "cad bar abc", "a b"]
    df = spark.createDataFrame([(t, "x") for t in texts], "text string, lang string")
    model, p = langid.train(df), plain_kneser_ney(texts, langid.ORDER)
    for text in ["abra cab", "zebra", "q", "bar abracad"]:
        code = [0] * (langid.ORDER - 1) + langid.folded(text).tolist()
        want = sum(np.log(p(tuple(code[i - langid.ORDER + 1 : i + 1]))) for i in range(langid.ORDER, len(code)))
        entropy, lengths = langid._entropies(model, [text])
        assert entropy[0, 0] * lengths[0] == pytest.approx(-want, rel=1e-4)


def test_no_size_makes_the_model_drop_ngrams(spark):
    rows = [("the thing that the others think " * 9, "big"), ("the other thing is there again " * 9, "big"), ("zyx wvu tsr", "rare")]
    table = langid.counted(spark.createDataFrame(rows, "text string, lang string"))
    assert table.where("lang = 'rare' and n >= 2").isEmpty()
    model = langid.train(spark.createDataFrame(rows, "text string, lang string"))
    assert model.langs == ["big", "rare"] and len(model.keys[-1]) == table.select("gram").distinct().count()
    entropy, _ = langid._entropies(model, ["zyx wvu tsr"])
    assert entropy[0].argmin() == 1


def test_rejection_of_an_unseen_language(spark):
    """One of four languages is never taught: most of its texts are rejected, few of the others', learned from or not."""
    rnd = random.Random(6)
    rows = [*language_rows(n=2000), *((3000 + i, " ".join("".join(rnd.choices(["ska", "ij", "oe", "dz", "kk"], k=3)) for _ in range(rnd.randint(10, 60))), None) for i in range(300))]
    df = spark.createDataFrame([(i, t, None if i % 5 == 0 else lang) for i, t, lang in rows], "doc_id bigint, text string, lang string")
    got = langid.identify(df, F.lit(True), ["doc_id"]).collect()
    alien, own = [r.rejected for r in got if r.doc_id >= 3000], [r.rejected for r in got if r.doc_id < 2000]
    assert sum(alien) / len(alien) > 0.95 and sum(own) / len(own) < 0.01


def test_shards_add_up_to_the_whole_model(spark):
    df = spark.createDataFrame(language_rows(n=400) + [(900, None, "aa"), (901, "!", None), (902, "ção the über", None)], "doc_id bigint, text string, lang string")
    counts = langid.counted(df.where("lang is not null and text is not null")).cache()
    whole, cut = langid.Counts(counts, "n", 1 << 40), langid.Counts(counts, "n", 300)
    assert whole.shards == 1 < 4 < cut.shards
    sizes = [len(cut.model(i).keys[-1]) for i in range(cut.shards)]
    assert sum(sizes) == len(whole.model().keys[-1]) and max(sizes) < sum(sizes) / 2
    one, many = ({r.doc_id: (r._h, r._n) for r in langid.with_entropies(df, c, ["doc_id"]).collect()} for c in (whole, cut))
    assert set(one) == set(many)
    for i, (h, n) in one.items():
        assert many[i] == (pytest.approx(h, abs=1e-6), n)
    answers = [sorted((r.doc_id, r.lang_pred, r.rejected) for r in langid.identify(df, F.lit(True), ["doc_id"], cells=c).collect()) for c in (1 << 40, 300)]
    assert answers[0] == answers[1]


def test_trial_counts_leave_a_tenth_out(spark):
    df = spark.createDataFrame([(t, lang) for _, t, lang in language_rows()], "text string, lang string")
    sums = langid.counted(df).groupBy().sum("n", "n_trial").first()
    left_out = langid.counted(df.where(~langid.trial_fold())).groupBy().sum("n", "n_trial").first()
    assert 0.8 * sums[0] < sums[1] == left_out[0] == left_out[1] < sums[0]


def test_letters_beyond_the_basic_plane_and_marks():
    osage, adlam = chr(0x104B0) * 3, chr(0x1E900) * 3
    assert langid.folded(osage).tolist() != langid.folded(adlam).tolist() and len(langid.folded(osage)) == 5
    assert 32 not in langid.folded("हिन्दी").tolist()[1:-1] and 32 not in langid.folded("ภาษาไทยที่").tolist()[1:-1]
    for nothing in ("", None, "12 +", chr(0x301), "\u2764\ufe0f"):
        assert not len(langid.folded(nothing))


def test_model_is_the_same_built_in_stretches(spark, monkeypatch):
    docs = spark.createDataFrame([(t, lang) for _, t, lang in language_rows()], "text string, lang string")
    whole = langid.train(docs)
    monkeypatch.setattr(langid, "CHUNK", 37)
    parts = langid.train(docs)
    assert all((a == b).all() for a, b in zip(whole.logp, parts.logp, strict=True))


def test_long_texts_are_cut_without_a_trace(monkeypatch):
    code = langid.folded("the quick brown fox jumps over the lazy dog " * 9)
    whole = langid.grams(code)
    monkeypatch.setattr(langid, "CHUNK", 37)
    assert np.concatenate(list(langid.pieces(code))).tolist() == whole.tolist()
