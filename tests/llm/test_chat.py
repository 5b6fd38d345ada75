import json

import checker
from hypothesis import given, settings
from hypothesis import strategies as st

from alertloom.llm import catalog, chat

PIECES = ["<", "[", "\\", "s>", "/s>", "INST]", "/INST]", "<SYS>>", " ", "x", "ROLE]", "[/TURN]", "</s>"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PIECES)).map("".join), st.sampled_from(["user", "assistant", "system", "tool [/ROLE] ", ""]))
def test_round_trip(text, role):
    formatted, a, b = chat.render(role, text)
    follow = chat.render("user", text)[0]
    assert chat.read_turn(formatted + follow) == (role, text, len(formatted))
    assert chat.read_turn(formatted + follow, len(formatted)) == ("user", text, len(formatted + follow))
    assert chat.unescape(formatted[a:b]) == (text if role == "assistant" else "")


def test_layouts(spark):
    records = [
        {"role": "user", "text": "q"},
        {"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": None}]},
        {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]},
        {"instruction": "i", "input": "", "output": "o"},
        {"instruction": "i", "input": "n", "output": "o"},
        {"prompt": "p", "completion": "c"},
        {"data": {"prompt": "p", "response": "r"}},
        {"messages": []},
        {"unheard": 1},
    ]
    rows = [(k, 0, json.dumps(r)) for k, r in enumerate(records)] + [(98, 0, "{broken"), (99, 0, None)]
    found = chat.canonical_turns(spark.createDataFrame(rows, "conv_id long, turn long, record string")).collect()
    turns = {}
    for r in sorted(found, key=lambda r: (r.conv_id, r.part)):
        turns.setdefault(r.conv_id, []).append((r.role, r.text))
    assert turns[0] == [("user", "q")]
    assert turns[1] == [("user", "q"), ("assistant", "")]
    assert turns[2] == [("user", "q"), ("assistant", "a")]
    assert turns[3] == [("user", "i"), ("assistant", "o")]
    assert turns[4] == [("user", "i\n\nn"), ("assistant", "o")]
    assert turns[5] == [("user", "p"), ("assistant", "c")] and turns[6] == [("user", "p"), ("assistant", "r")]
    assert 7 not in turns
    assert turns[8] == turns[98] == turns[99] == [(None, None)]


def test_fingerprint_ignores_order():
    a, b = {"x": 1, "y": [{"u": 1}, {"v": 2}]}, {"y": [{"v": 2, "u": 3}], "x": None}
    assert chat.fingerprint(chat.field_paths(a)) == chat.fingerprint(chat.field_paths(b))


def test_query_and_edges(spark, sf_dir, tmp_path):
    con = checker.connect(sf_dir)
    assert checker.compare(chat.op2_chat(spark, sf_dir), con, catalog.ORACLES["op2_chat"]) == []
    rows = [(1, 0, "user", None), (1, 1, None, "x"), (None, None, "assistant", "</s>"), (2, 0, "assistant", ""), (2, 0, "assistant", "")]
    rows += [(3, k, "assistant" if k % 2 else "user", "word " * 2000) for k in range(300)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    table.write.parquet(f"{tmp_path}/conversations.parquet")
    con.execute(f"CREATE OR REPLACE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    assert checker.compare(chat.op2_chat(spark, str(tmp_path)), con, catalog.ORACLES["op2_chat"]) == []
    assert chat.op2_chat(spark, str(tmp_path)).filter("conv_id = -7").first().loss_chars == len("</s>[INST] ok [/INST]")


def test_malformed_records_are_of_unknown_layout(spark):
    texts = [
        '{"messages": ["x"]}',
        '{"messages": [null]}',
        '{"messages": [{"role": "user", "content": "q"}, "stray"]}',
        '{"messages": [[{"role": "user", "content": "q"}]]}',
        "[" * 100_000,
        '{"a":' * 100_000 + "1" + "}" * 100_000,
        "no json",
        None,
    ]
    rows = [(k, 0, t) for k, t in enumerate(texts)] + [(99, 0, '{"messages": [{"role": "user", "content": "q"}]}')]
    found = chat.canonical_turns(spark.createDataFrame(rows, "conv_id long, turn long, record string")).collect()
    assert {r.conv_id for r in found if r.layout is None} == set(range(len(texts)))
    assert [(r.role, r.text) for r in found if r.layout] == [("user", "q")]
