"""The pipeline stage by stage, and the registered queries over the smallest tables."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

from roadflux.llm import decontaminate, minhash, queries
from roadflux.llm.bpe import codec, default_vocabulary

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    import corpus_pipeline

    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    frames = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, DATA).write.parquet(str(folder / name))
        docs = frames[name] = spark.read.parquet(str(folder / name))
    return frames


def test_stages_keep_columns_and_shrink(stages):
    names = list(stages)
    assert names == ["documents", "quality", "language", "near_duplicates", "decontamination", "encoding"]
    for a, b in zip(names[:-2], names[1:-1], strict=True):
        assert stages[a].columns == stages[b].columns and stages[b].count() <= stages[a].count()
        assert stages[b].join(stages[a], stages[a].columns, "left_anti").count() == 0  # nothing is altered
    assert stages["language"].count() >= 0.9 * stages["quality"].count()


def test_duplicates_against_brute_force(stages):
    from test_minhash import brute

    rows = [(r.doc_id, r.text) for r in stages["language"].collect()]
    assert {r.doc_id for r in stages["near_duplicates"].collect()} == {d for d, _, _, own in brute(rows, 5, 80) if own}


def test_decontamination_against_brute_force(spark, stages):
    items = [decontaminate.normal(r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    whole = {r.doc_id for r in stages["near_duplicates"].collect() if not any(i in decontaminate.normal(r.text) for i in items)}
    assert {r.doc_id for r in stages["decontamination"].collect()} <= whole
    assert len(whole) - stages["decontamination"].count() <= 2  # the rest would hold an edited item


def test_encoding_decodes_to_the_text(stages):
    import public_tokenizers

    own = codec(default_vocabulary(), public_tokenizers.PATTERN)
    texts = {r.doc_id: r.text for r in stages["decontamination"].collect()}
    rows = stages["encoding"].collect()
    assert len(rows) == len(texts) and all(own.decode(r.token_ids).decode() == texts[r.doc_id] for r in rows)


def test_run_equals_the_stages(spark, stages):
    import corpus_pipeline

    got = corpus_pipeline.run(spark, DATA)
    assert got.columns == stages["encoding"].columns
    assert sorted(map(tuple, got.select("doc_id", "ids_sha256").collect())) == sorted(map(tuple, stages["encoding"].select("doc_id", "ids_sha256").collect()))


def test_stages_on_nothing(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{DATA}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, DATA).count() == 0


def test_clashing_columns_and_odd_rows(spark, tmp_path):
    """Extra columns come through unaltered, whatever their names; nulls, empties and repeats are defined."""
    import corpus_pipeline

    extra = ["score", "rejected", "_row", "_text", "key", "row", "may", "a b", "cid", "entropy"]
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (900001, "", "en", None, 0), (900002, "!!! 123", None, "s", 3), (None, "short text", "en", "s", 9)], docs.schema)
    rows = docs.unionByName(docs.where("doc_id = 7")).unionByName(odd).withColumns({c: F.concat(F.lit(c), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))) for c in extra})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, rows, DATA)
        assert out.columns == rows.columns
        out.write.parquet(str(tmp_path / name))
        got = spark.read.parquet(str(tmp_path / name))
        assert got.count() <= rows.count() and got.where("`a b` != concat('a b', coalesce(cast(doc_id as string), '-')) or score != concat('score', coalesce(cast(doc_id as string), '-'))").count() == 0
        rows = got
    assert rows.where("doc_id = 7").count() == 1 and rows.where("doc_id = 900002").count() == 0


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_against_sql(spark, name):
    con = duckdb.connect()
    for table in ("pages", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    found = con.execute(queries.oracle_sql()[name])
    names = [d[0] for d in found.description]
    df = queries.queries()[name](spark, DATA)
    assert sorted(df.columns) == sorted(names)
    assert sorted(repr(tuple(r[n] for n in names)) for r in df.collect()) == sorted(map(repr, found.fetchall()))


def test_op7_finds_whole_items(spark):
    items = {r.item_id: decontaminate.normal(r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()}
    docs = spark.read.parquet(f"{DATA}/documents.parquet").collect()
    want = {(d.doc_id, i) for d in docs for i, t in items.items() if t in decontaminate.normal(d.text)}
    got = {(r.doc_id, r.item_id): r.distance for r in queries.op7_decontamination(spark, DATA).collect()}
    assert want and {k for k, d in got.items() if d == 0} == want


def test_op7_against_distances_to_the_whole_text(spark):
    """Every item against every shorter document by the plain scan over the whole text, without pieces."""
    bench = [(r.item_id, decontaminate.normal(r.text)) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    docs = [(r.doc_id, decontaminate.normal(r.text)) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    docs = {d: t for d, t in docs if len(t) < 3000}
    items = [(i, t, int(len(t) * 0.08), decontaminate.Myers(t)) for i, t in bench]
    hits = ((d, i, m.best(t, budget)) for d, t in docs.items() for i, _, budget, m in items)
    want = {(d, i): (hit[0], hit[1]) for d, i, hit in hits if hit}
    got = {(r.doc_id, r.item_id): (r.distance, r.match_end) for r in queries.op7_decontamination(spark, DATA).collect() if r.doc_id in docs}
    assert got == want and any(distance for distance, _ in want.values()) == any(r[0] for r in got.values())


def test_quality_and_language_stages_row_by_row(spark, stages):
    """What the two filters keep, from scores that are taken of every text alone."""
    from test_classifiers import plain_attention, plain_passages

    from roadflux.llm import langid, quality
    from roadflux.llm.common import learns

    docs = stages["documents"]
    model = quality.train(docs, spark.read.parquet(f"{DATA}/labels.parquet"), learns("doc_id", 5) != 0)
    good = {r.doc_id for r in docs.collect() if plain_attention(model, plain_passages(r.text)) >= 0.3}
    assert {r.doc_id for r in stages["quality"].collect()} == good
    known = stages["quality"].where("lang is not null and text is not null")
    counts = langid.counted(known)
    trial, full = langid.Counts(counts, "n_trial", 1 << 40), langid.Counts(counts, "n", 1 << 40).model()
    ceilings = langid.ceilings_of(langid.trials(known.where(langid.trial_fold()), trial), full.langs, 8.0, 12.0)
    kept = set()
    for r in stages["quality"].collect():
        entropy, lengths = langid._entropies(full, [r.text])
        best = entropy[0].argmin()
        if lengths[0] and entropy[0, best] <= ceilings[best, (langid.LENGTHS < lengths[0]).sum()]:
            kept.add(r.doc_id)
    assert {r.doc_id for r in stages["language"].collect()} == kept


def test_op8_and_op10_against_brute_force(spark):
    from test_embeddings import brute as vectors
    from test_minhash import brute as texts

    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    assert sorted(map(tuple, queries.op8_minhash(spark, DATA).collect())) == sorted(texts(docs, 4, 80))
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{DATA}/embeddings.parquet").collect()]
    assert sorted(map(tuple, queries.op10_embeddings(spark, DATA).collect())) == vectors(rows)


def test_scores_are_whole(spark):
    n = spark.read.parquet(f"{DATA}/documents.parquet").count()
    for name in ("op3_toxicity", "op4_language", "op6_quality"):
        df = queries.queries()[name](spark, DATA)
        assert df.count() == n and df.where((F.col("score") < 0) | (F.col("score") > 1)).count() == 0
    assert minhash.BANDS * minhash.ROWS == 128
