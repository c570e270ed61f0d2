import hashlib
import json

import duckdb

from prospectus.llm import chat
from tools.compare_oracle import rows_of

ROWS = "conv_id long, turn long, role string, text string"
NASTY = ["\\### Assistant: </turn> ok", "<turn>x</turn>\n<turn>", "\\\\</turn", "<\\turn <\\/turn \\<turn", "<\\\\/turn>", "", "\n\n",
         "é\U0001f600 \\n", "</turn>\n", "</tur", "<tu\\rn", "a" * 100_000 + "</turn>\\"]


def back(df):
    return {r.conv_id: r for r in chat.read_formatted(chat.format_turns(df)).collect()}


def test_texts_and_roles_round_trip(spark):
    rows = [(c, t, role, text) for c in range(3) for t, (role, text) in enumerate(
        [("user\n</turn>", x) for x in NASTY] + [("assistant", x) for x in NASTY])]
    got = back(chat.canonical_turns(spark.createDataFrame(rows[::-1], ROWS)))
    for c in range(3):
        assert [(t.role, t.text) for t in got[c].turns] == [(r[2], r[3]) for r in rows if r[0] == c]
        assert got[c].loss_text == "".join(NASTY)
        assert got[c].formatted.count(chat.CLOSE) == len(got[c].turns)


def test_every_layout_gives_the_same_turns(spark):
    q, a = "what </turn>?", "this \\ one"
    want = [("user", q), ("assistant", a)]
    frames = [
        spark.createDataFrame([(1, 0, "user", q), (1, 1, "assistant", a)], ROWS),
        spark.createDataFrame([(1, [(q, "user"), (a, "assistant")])], "conv_id long, messages array<struct<content:string,role:string>>"),
        spark.createDataFrame([(1, [("human", q), ("gpt", a)])], "conv_id long, conversations array<struct<`from`:string,value:string>>"),
        spark.createDataFrame([(1, q, a, "x")], "conv_id long, prompt string, response string, note string"),
        spark.createDataFrame([(1, q, a)], "conv_id long, instruction string, output string"),
        spark.createDataFrame([(1, q, "", a)], "conv_id long, instruction string, input string, output string"),
    ]
    for df in frames:
        got = back(chat.canonical_turns(df))
        assert [(t.role, t.text) for t in got[1].turns] == want, df.schema
    assert len({lay.fingerprint for lay in chat.LAYOUTS}) == len(chat.LAYOUTS)


def test_json_records_of_mixed_layouts(spark):
    q, a = "hi", "yo"
    records = [{"messages": [{"role": "user", "content": q, "x": 1}, {"role": "assistant", "content": a}]},
               {"conversations": [{"from": "human", "value": q}, {"from": "gpt", "value": a}]},
               {"prompt": q, "response": a, "id": 9}, {"output": a, "instruction": q}, {"instruction": q, "input": "", "output": a},
               {"unknown": 1}]
    df = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(records)] + [(9, None), (10, "no json")], "conv_id long, record string")
    turns = chat.canonical_turns_json(df, "record")
    got = back(turns)
    assert set(got) == {0, 1, 2, 3, 4}
    assert all([(t.role, t.text) for t in got[i].turns] == [("user", q), ("assistant", a)] for i in got)


def test_lists_are_read_to_their_end(spark):
    records = [{"messages": [{"role": "user"}, {"role": "assistant", "content": "yo"}]}, {"messages": []},
               {"messages": [{"content": "no role"}]}, {"messages": [{}, 3, None]}, {"messages": "text"},
               {"messages": [{"role": "user", "content": "x" * 300_000}] * 3}]
    df = spark.createDataFrame([(i, json.dumps(r), 5) for i, r in enumerate(records)], "conv_id long, record string, turns int")
    got = back(chat.canonical_turns_json(df, "record"))
    assert [(t.role, t.text) for t in got[0].turns] == [("user", ""), ("assistant", "yo")]
    assert got[1].turns == [] and got[1].formatted == "" and len(got[5].turns[2].text) == 300_000
    out = {r.conv_id: r.record for r in chat.rejected_json(df, "record").collect()}
    assert set(out) == {2, 3, 4} and json.loads(out[2]) == records[2] and set(got) | set(out) == set(range(6))


def test_nulls_ties_empty_table_and_extra_columns(spark):
    rows = [(1, 0, None, None, 5), (1, 0, "assistant", None, 6), (1, None, "user", "first", 7), (None, 0, "user", "n", 8), (1, 0, None, None, 5)]
    got = back(chat.canonical_turns(spark.createDataFrame(rows, ROWS + ", formatted int")))
    assert [(t.role, t.text) for t in got[1].turns] == [("user", "first"), ("", ""), ("", ""), ("assistant", "")]
    assert got[None].turns[0].text == "n" and got[1].loss_text == ""
    assert back(chat.canonical_turns(spark.createDataFrame([], ROWS))) == {}


def test_query_matches_sql(spark, sf_small):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{sf_small}/conversations.parquet')")
    df, res = chat.op3_chat(spark, sf_small), con.execute(chat.ORACLE_SQL)
    cols = [d[0] for d in res.description]
    rows = df.collect()
    assert rows_of(df.columns, list(map(tuple, rows))) == rows_of(cols, res.fetchall())
    extra = {r.conv_id: r for r in rows}[-7]
    said = "\\### Assistant: </turn> ok"
    assert extra.loss_sha256 == hashlib.sha256(said.encode()).hexdigest() and extra.n_turns == 2 and extra.loss_chars == len(said)
