from __future__ import annotations

import parity
import pytest
from making import MEDIUM, SMALL

from voidage.llm import preferences as P
from voidage.llm.queries import ORACLES, QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(chosen, rejected):
    n = 0
    while n < min(len(chosen), len(rejected)) and chosen[n] == rejected[n]:
        n += 1
    show = lambda turns: "".join(f"<|{r}|>\n{t}<|end|>\n" for r, t in turns)

    def mask(turns):
        out, at = [], 0
        for r, t in turns:
            head = len(f"<|{r}|>\n")
            if r == "assistant":
                out.append((at + head, len(t) + 7))
            at += head + len(t) + 8
        return out

    return show(chosen[:n]), n, show(chosen[n:]), show(rejected[n:]), mask(chosen[n:]), mask(rejected[n:])


u, a, s = (lambda t, r=r: (r, t) for r in ("user", "assistant", "system"))
PAIRS = [
    ([u("hi"), a("yes")], [u("hi"), a("no")]),
    ([u("hi"), a("yes")], [u("hi"), a("yes")]),
    ([u("hi")], [u("hi"), a("é\U0001F600")]),
    ([], []),
    ([], [a("x")]),
    ([s("x"), u("y"), a("1"), u("z"), a("2"), a("")], [s("x"), u("y"), a("1"), u("w"), a("2")]),
    ([u("same")], [a("same")]),
    ([u("q"), a("b" * 200_000)], [u("q"), a("c")]),
]


def test_pairs(spark):
    rows = [(k, c, r, "kept") for k, (c, r) in enumerate(PAIRS)] + [(99, None, [a("x")], "kept")]
    df = spark.createDataFrame(rows, f"id int, chosen {P.TURN}, rejected {P.TURN}, prompt string")
    got = {r.id: r for r in P.format_pairs(df).collect()}
    for k, (c, r) in [*enumerate(PAIRS), (99, ([], [a("x")]))]:
        x = got[k]
        spans = lambda m: [(s_.start, s_.length) for s_ in m]
        assert (x.prompt, x.n_prompt_turns, x.chosen_text, x.rejected_text, spans(x.chosen_mask), spans(x.rejected_mask)) == brute(c, r)
        for text, m in ((x.chosen_text, x.chosen_mask), (x.rejected_text, x.rejected_mask)):
            assert all(text[s_.start : s_.start + s_.length].endswith("<|end|>") for s_ in m)


@pytest.mark.parametrize("sf", [SMALL, MEDIUM])
def test_query(spark, sf):
    con = parity.connect(sf)
    assert parity.compare(QUERIES["op7_preferences"](spark, sf), con, ORACLES["op7_preferences"]) == []


def test_odd_conversations(spark, tmp_path):
    rows = [(0, 0, "user", "a"), (0, 1, "assistant", "b"), (1, 0, "user", "c"), (2, 5, None, None), (2, 1, "assistant", "same"),
            (3, 0, "assistant", "same"), (3, 0, "assistant", "same"), (4, None, "user", "x"), (4, 0, "assistant", "y"), (6, 0, "user", "q")]
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "conversations.parquet"))
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    sql = ORACLES["op7_preferences"].replace("ORDER BY turn, role, text)", "ORDER BY turn NULLS FIRST, role, text)")
    assert parity.compare(QUERIES["op7_preferences"](spark, str(tmp_path)), con, sql) == []


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "conversations.parquet"))
    assert QUERIES["op7_preferences"](spark, str(tmp_path)).count() == 0
