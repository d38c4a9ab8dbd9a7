import hashlib
import os
import random

import pytest
from hypothesis import given, settings, strategies as st

from tests.compare import connect, difference
from trendcast.llm import chat, queries

SCHEMA = "conv_id long, turn long, role string, text string"
PIECES = ["<s>", "</s>", "[INST]", "[/INST]", "[SYS]", "[/SYS]", "[ROLE]", "[IS]", "[/ROLE]", "[\\INST]", "<\\\\/s>", "\\", "<", "[",
          "/s>", "INST]", " ", "a", "é", "\n", "😀", ">", "]"]
text = st.lists(st.sampled_from(PIECES), max_size=8).map("".join)
role = st.sampled_from(["user", "assistant", "system", "tool", "", "[IS]", "a[/ROLE]", "<\\s>"])


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(role, text), max_size=6))
def test_round_trip(turns):
    formatted = "".join(chat.rendered_turn(*t) for t in turns)
    assert [t[:2] for t in chat.parsed(formatted)] == turns
    for who, content, (a, b) in chat.parsed(formatted):
        assert chat.unescaped(formatted[a:b]) == content


@given(text)
def test_escaping_is_reversible_and_plain_texts_stay(content):
    assert chat.unescaped(chat.escaped(content)) == content
    assert chat.rendered_turn("user", "plain " + content.replace("<", "").replace("[", "")).count("\\") == content.count("\\")


def test_grammar_refuses_what_it_did_not_write():
    for bad in ("hello", "[INST]a", "[INST]a</s>", "[/INST]", "[ROLE]x[/ROLE]", "<s>a</s>b"):
        with pytest.raises(chat.NotATurn):
            list(chat.parsed(bad))


def want(rows):
    rows = sorted(((t, r or "", x or "") for _, t, r, x in rows),
                  key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2][:64], hashlib.md5(r[2].encode()).hexdigest()))
    said = "".join(x for _, r, x in rows if r == "assistant")
    return (len(rows), hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in rows).encode()).hexdigest(), len(said),
            hashlib.sha256(said.encode()).hexdigest())


@pytest.mark.parametrize("bounds", [{}, {"most_rows": 2}])
def test_reports_equal_plain_python(spark, bounds):
    rng = random.Random(1)
    rows = [(c, rng.choice([None, i]), rng.choice(["user", "assistant", "system", "to[IS]ol", None]),
             rng.choice([None, "", "".join(rng.choices(PIECES, k=9))]))
            for c in [None, *range(60)] for i in range(rng.randrange(1, 12))]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as at", "2 as n", "3 as formatted", "4 as several_id")
    got = chat.reports(chat.formatted(df, **bounds)).collect()
    by = {}
    for r in rows:
        by.setdefault(r[0], []).append(r)
    assert len(got) == len(by)
    for r in got:
        assert tuple(r)[1:5] == want(by[r.conv_id])
        assert r.formatted_chars >= sum(len(x or "") for _, _, _, x in by[r.conv_id])


def test_empty_table_and_query(spark, tmp_path):
    assert chat.reports(chat.formatted(spark.createDataFrame([], SCHEMA))).count() == 0
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    row = queries.QUERIES["op13_chat_format"](spark, str(tmp_path)).collect()
    said = "</s>[INST] ok [/INST]"
    assert [tuple(r) for r in row] == [(-1, 2, *want([(0, 0, "user", said), (0, 1, "assistant", said)])[1:], 2 * 24 + 20)]


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="test tables are not here")
def test_query_equals_sql(spark):
    assert not difference(spark, connect("/root/testdata/sf0.01"), "op13_chat_format", "/root/testdata/sf0.01")
