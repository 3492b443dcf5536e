import random

import duckdb
import pytest

from roadflux.llm.chat import linked, parsed
from roadflux.llm.sql import OP9

SCHEMA = "conv_id bigint, turn bigint, role string, text string, reply string"
ROWS = [
    (1, 0, "user", "How do I sort a long list quickly?\nThanks in advance to all!"),
    (1, 1, "assistant", "> How do I sort a long list quickly?\nUse the sorted function."),
    (1, 2, "user", ">> How do I sort a long list quickly?\n> Use the sorted function.\nAnd in reverse order, please?"),
    (1, 3, "assistant", "> and in REVERSE order -- please\n\nPass reverse equals true."),
    (1, 4, "user", "Another thing entirely: what about tuples here?"),
    (1, 5, "assistant", "> How do I sort a long list quickly?\n> Thanks in advance to all!\nYou are welcome."),
    (2, 0, "user", "> Use the sorted function.\nI read this elsewhere."),
    (2, 1, "assistant", "> nobody ever wrote this sentence\nUnknown source."),
    (2, 2, "user", "> ok\n   > > How do I sort a long list quickly?\nx > y is no quotation"),
    (3, 0, "user", None), (3, 1, "assistant", ""), (3, 2, "user", "> "), (3, None, "user", "> Use the sorted function."), (None, 1, "user", "Use the sorted function."),
    (1, 4, "user", "Another thing entirely: what about tuples here?"),
]


def frame(spark, rows=ROWS):
    return spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA)


def test_links_and_order(spark):
    got = {(r.conv_id, r.turn): r for r in linked(frame(spark)).collect()}
    parent = {k: (r.parent_conv, r.parent_turn) for k, r in got.items()}
    assert parent[1, 1] == (1, 0) and parent[1, 2] == (1, 1) and parent[1, 3] == (1, 2) and parent[1, 5] == (1, 0)
    assert parent[2, 0] == (1, 1) and parent[2, 1] == (None, None) and parent[2, 2] == (1, 0)
    assert {k: (r.thread_turn, r.depth) for k, r in got.items() if k[0] == 1} == {(1, 0): (0, 0), (1, 1): (0, 1), (1, 2): (0, 2), (1, 3): (0, 3), (1, 4): (4, 0), (1, 5): (0, 1)}
    assert got[1, 2].levels == 2 and got[1, 2].n_quotes == 2 and got[1, 2].reply == "And in reverse order, please?"
    assert got[1, 3].reply == "Pass reverse equals true." and got[2, 2].reply == "x > y is no quotation"
    assert got[3, 0].reply == "" and got[3, 2].reply == "" and got[3, 2].levels == 1
    order = [(r.conv_id, r.turn) for r in linked(frame(spark).repartition(3)).collect() if r.conv_id == 1]
    assert order == [(1, 0), (1, 1), (1, 2), (1, 3), (1, 5), (1, 4), (1, 4)]


@pytest.mark.parametrize("seed", [None, 1, 2])
def test_against_sql(spark, seed):
    con, rows = duckdb.connect(), ROWS
    if seed:  # few sentences, so that the first conversation with a passage often is the quoting one
        rnd, said = random.Random(seed), ["yes", "no", "a longer sentence here", "another sentence there", "one more of them"]
        rows = [(c, t, "user", "\n".join(rnd.choice(["", "", "> ", ">> "]) + rnd.choice(said) for _ in range(rnd.randint(1, 4)))) for c in range(8) for t in range(6)]
    con.register("conversations", frame(spark, rows).select("conv_id", "turn", "role", "text").toPandas().astype({"conv_id": "Int64", "turn": "Int64"}))
    found = con.execute(OP9)
    names = [d[0] for d in found.description]
    want = sorted(map(repr, found.fetchall()))
    assert sorted(repr(tuple(r[n] for n in names)) for r in linked(frame(spark, rows)).collect()) == want


def test_the_first_original_may_be_the_quoting_conversation(spark):
    """The conversation that quotes holds the passage itself, but later: the next conversation has the original."""
    line = "a sentence that several people write"
    rows = [(1, 3, "user", f"> {line}\nyes"), (1, 5, "user", line), (2, 0, "user", line), (3, 0, "user", line), (4, 1, "user", f"> {line}\nno")]
    got = {(r.conv_id, r.turn): (r.parent_conv, r.parent_turn) for r in linked(frame(spark, rows)).collect()}
    assert got[1, 3] == (2, 0) and got[4, 1] == (1, 5)
    alone = {(r.conv_id, r.turn): r.parent_conv for r in linked(frame(spark, rows[:2])).collect()}
    assert alone[1, 3] is None


def test_deep_chain(spark):
    rows = [(1, 0, "user", "message number zero begins")]
    rows += [(1, i, "user", f"> message number {['zero', i - 1][i > 1]} begins\nmessage number {i} begins") for i in range(1, 40)]
    got = {r.turn: r for r in linked(frame(spark, rows)).collect()}
    assert all(got[i].thread_turn == 0 and got[i].depth == i for i in range(40))


def test_one_passage_quoted_by_all(spark):
    rows = [(c, 0, "user", "the very same opening message") for c in range(30)] + [(c, 1, "user", "> the very same opening message\nanswer") for c in range(30)]
    got = linked(frame(spark, rows)).where("turn = 1").collect()
    assert len(got) == 30 and all((r.parent_conv, r.parent_turn) == (r.conv_id, 0) for r in got)


def test_short_quotes_link_inside_their_conversation(spark):
    rows = [(1, 0, "user", "Yes"), (1, 1, "user", "No, why?"), (1, 2, "user", "> yes\nI see"), (2, 0, "user", "> Yes\n> no why\nwho said that"), (2, 1, "user", "> !?\nnothing")]
    got = {(r.conv_id, r.turn): (r.parent_conv, r.parent_turn) for r in linked(frame(spark, rows)).collect()}
    assert got[1, 2] == (1, 0) and got[2, 0] == (None, None) and got[2, 1] == (None, None)


@pytest.mark.parametrize("rows", [[], ROWS[:1]])
def test_without_quotation(spark, rows):
    assert linked(frame(spark, rows)).count() == len(rows)


def test_many_passages_in_one_text(spark):
    text = "".join(f"> quoted line {i}\nown line {i}\n" for i in range(100_000))
    row = linked(frame(spark, [(1, 0, "user", text)])).first()
    assert row.n_quotes == 100_000 and row.reply.endswith("own line 99999") and row.reply.count("\n") == 99_999


def test_native_and_long(spark):
    df = linked(frame(spark, [(1, 0, "user", "> a long line of quotation\n" * 3000 + "end")]))
    row = df.first()
    assert row.reply == "end" and row.n_quotes == 1
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()
    assert parsed(frame(spark, ROWS[:3])).columns == ["conv_id", "turn", "role", "reply", "passages", "levels"]


def test_a_plain_message_that_shares_its_turn_with_a_quoting_one(spark):
    """Links belong to (conv_id, turn): both rows of the turn carry them, with and without other plain rows beside."""
    line = "a sentence that several people write"
    rows = [(1, 0, "user", line), (1, 1, "user", f"> {line}\nyes"), (1, 1, "assistant", "no"), (1, 2, "user", "well"), (None, 1, "user", "x"), (2, None, "user", f"> {line}")]
    got = {(r.conv_id, r.turn, r.role): (r.parent_turn, r.thread_turn, r.depth) for r in linked(frame(spark, rows)).collect()}
    assert got[1, 1, "user"] == got[1, 1, "assistant"] == (0, 0, 1)
    assert got[1, 2, "user"] == (None, 2, 0) and got[1, 0, "user"] == (None, 0, 0)
    assert got[None, 1, "user"] == (None, 1, 0) and got[2, None, "user"] == (None, None, 0)
