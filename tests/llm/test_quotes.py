"""Quotation links on written conversations."""

import duckdb

from tidemark.llm.op_queries import OP3_SQL
from tidemark.llm.quotes import linked_conversations

TALK = [
    (1, 0, "a", "Shall we meet on Monday?\nBring the plans."),
    (1, 1, "b", "> shall we  meet on monday?\nYes, at noon."),
    (1, 2, "c", "Unrelated news."),
    (1, 3, "a", "> > Shall we meet on Monday?\n> Yes, at noon.\nFine."),
    (1, 4, "c", "> Shall we meet on Monday?\n> Bring the plans.\nWhich plans?\n> never said\nHm."),
    (1, 5, "a", ">Which plans?\nThe old ones."),
    (2, 0, "a", None),
    (2, 1, "b", "> Yes, at noon.\nother conversation"),
    (3, 1, "b", "> later\nearly"),
    (3, 2, "b", "later"),
]


def rows(spark, data):
    kind = "conv_id long, turn long, role string, text string, place string"
    table = spark.createDataFrame([(*r, "x") for r in data], kind).repartition(4)
    return linked_conversations(table).collect()


def test_links_threads_and_order(spark):
    got = {(r.conv_id, r.turn): r for r in rows(spark, TALK)}
    assert {k: r.reply_to for k, r in got.items() if r.reply_to is not None} == {
        (1, 1): 0, (1, 3): 1, (1, 4): 0, (1, 5): 4
    }
    assert {k[1]: (r.thread, r.depth) for k, r in got.items() if k[0] == 1} == {
        0: (0, 0), 1: (0, 1), 2: (2, 0), 3: (0, 2), 4: (0, 1), 5: (0, 2)
    }
    order = sorted((r.place, r.turn) for r in got.values() if r.conv_id == 1)
    assert order == [(1, 0), (2, 1), (3, 3), (4, 4), (5, 5), (6, 2)]
    assert got[1, 3].body == "Fine." and got[1, 4].body == "Which plans?\nHm." and got[2, 0].body == ""
    assert (got[1, 4].n_passages, got[1, 4].n_linked, got[1, 4].n_quoted_lines) == (2, 1, 3)
    assert (got[1, 3].n_passages, got[1, 3].n_linked) == (2, 2)


def test_long_chains_and_odd_rows(spark):
    chain = [(7, 0, "a", "say 0")] + [(7, k, "a", f"> say {k - 1}\nsay {k}") for k in range(1, 40)]
    odd = [(None, 1, "a", "> say 0"), (7, None, None, ""), (8, 1, "a", "same"), (8, 1, "a", "same"), (9, 0, "a", "x " * 200_000)]
    got = rows(spark, chain + odd)
    assert len(got) == 45
    assert {r.turn: r.depth for r in got if r.conv_id == 7 and r.turn is not None} == {k: k for k in range(40)}
    assert all(r.thread == 0 for r in got if r.conv_id == 7 and r.turn is not None)
    assert sorted(r.place for r in got if r.conv_id == 8) == [1, 2]
    assert all(r.place is None for r in got if r.conv_id is None or r.turn is None)


def test_one_thread_of_a_hot_conversation_is_cut(spark):
    """All answers lead to one message: the thread is cut along its turns."""
    talk = [(5, 0, "a", "What do you think?")] + [(5, k, "b", f"> What do you think?\nanswer {k}") for k in range(1, 700)]
    spark.conf.set("spark.tidemark.hotRows", "60")
    try:
        got = rows(spark, talk)
    finally:
        spark.conf.unset("spark.tidemark.hotRows")
    assert {r.thread for r in got} == {0}
    assert sorted((r.place, r.turn) for r in got) == [(k + 1, k) for k in range(700)]


def test_empty(spark):
    assert rows(spark, []) == []


def test_sql_agrees_where_messages_quote(spark, tmp_path):
    kind = "conv_id long, turn long, role string, text string"
    spark.createDataFrame(TALK, kind).coalesce(1).write.parquet(str(tmp_path / "talk"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/talk/*.parquet')")
    names = ["conv_id", "turn", "body", "n_quoted_lines", "n_passages", "n_linked", "reply_to", "thread", "depth", "place"]
    want = con.execute(f"SELECT {', '.join(names)} FROM ({OP3_SQL})").fetchall()
    got = [tuple(r[n] for n in names) for r in linked_conversations(spark.read.parquet(str(tmp_path / "talk"))).collect()]
    assert sorted(got) == sorted(want)
