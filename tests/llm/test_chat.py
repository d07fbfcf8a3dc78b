import hashlib

import oracle
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import types as T

from candleworks.llm import chat, oracles, queries

CONTROL = st.lists(st.sampled_from([*"<|\\\nab", "<|im_end|>", "<|im_start|>"]), max_size=30).map("".join)


@given(CONTROL)
def test_escape_is_reversible(text):
    assert "<|" not in chat.escape(text)
    assert chat.unescape(chat.escape(text)) == text
    assert chat.unescape_role(chat.escape_role(text)) == text and "\n" not in chat.escape_role(text)


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "a\n<|im_start|>"]), CONTROL), max_size=5))
def test_turns_round_trip(turns):
    visitor = chat.Visitor()
    text = "".join(chat.format_turn(r, [{"type": "text", "text": t}], visitor)["formatted"] for r, t in turns)
    assert [(r, chat.unescape(c)) for r, c in chat.parse_turns(text)] == turns


def test_parts_are_flattened_in_order():
    parts = [
        {"type": "text", "text": "look <|image|> "},
        {"type": "image", "ref": "s3://a.png", "width": 57, "height": 28},
        {"type": "audio", "ref": "b.wav", "seconds": 1.5},
        {"type": "text", "text": None},
        {"type": "document", "ref": "c.pdf", "pages": 3},
    ]
    turn = chat.format_turn("assistant", parts, chat.Visitor())
    assert turn["formatted"] == "<|im_start|>assistant\nlook <\\|image|> <|image|><|audio|><|document|><|im_end|>\n"
    found = [(a["type"], a["ref"], a["tokens"]) for a in turn["attachments"]]
    assert found == [("image", "s3://a.png", 3), ("audio", "b.wav", 38), ("document", "c.pdf", 1920)]
    for a in turn["attachments"]:
        assert turn["formatted"][a["start"] : a["start"] + a["length"]] == f"<|{a['type']}|>"
    start = turn["content_start"]
    assert turn["formatted"][start : start + turn["content_length"]].startswith("look")
    assert turn["loss"]


def test_typed_parts_in_a_table(spark):
    schema = T.StructType(
        [
            T.StructField("conv_id", T.LongType()), T.StructField("turn", T.IntegerType()), T.StructField("role", T.StringType()),
            T.StructField("parts", T.ArrayType(chat.PART)), T.StructField("formatted", T.StringType()),
        ]
    )
    text, image = ("text", "hi", None, None, None, None, None), ("image", None, "r", 28, 56, None, None)
    rows = [(1, 0, "user", [text, image], "clash"), (1, 1, "assistant", None, "clash"), (1, None, None, [], "clash")]
    out = chat.formatted(spark.createDataFrame(rows, schema)).collect()
    assert out[0].formatted == "<|im_start|>user\nhi<|image|><|im_end|>\n" and out[0].attachments[0].tokens == 2
    assert out[1].content_length == 0 and out[2].formatted == "<|im_start|>\n<|im_end|>\n"


def test_registered_query_equals_sql(spark):
    sf_dir = "/root/testdata/sf0.001"
    name = "op7_chat_parts"
    assert oracle.differences(spark, oracle.connect(sf_dir), sf_dir, queries.QUERIES[name], oracles.SQL[name]) == []


def test_awkward_conversations(spark):
    kind = "conv_id long, turn long, role string, text string, loss string"
    rows = [(None, None, None, None, "x"), (1, 1, "assistant", "b", "x"), (1, 0, "user", None, "x"), (1, 1, "assistant", "b", "x")]
    rows += [(2, i, "assistant", "long " * 100, "x") for i in range(500)]
    got = {r.conv_id: r for r in chat.read_back(chat.formatted(spark.createDataFrame(rows, kind))).collect()}
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got[None].turns_sha256 == digest("\n\n") and got[None].loss_sha256 == digest("")
    assert got[1].turns_sha256 == digest("user\n\nassistant\nb\nassistant\nb\n") and got[1].loss_chars == 2
    assert got[2].n_turns == 500 and got[2].loss_sha256 == digest("long " * 50_000)
    assert chat.read_back(chat.formatted(spark.createDataFrame([], kind))).count() == 0


def test_unknown_parts_become_placeholders():
    flat = chat.Visitor().flatten([{"type": "text", "text": "a"}, {"type": "video", "ref": "v.mp4"}, {"type": "flatten"}, {"text": "b"}])
    assert flat.content == "a<|unknown|><|unknown|>b"
    assert [(a["type"], a["ref"], a["tokens"], a["start"]) for a in flat.attachments] == [("video", "v.mp4", 1, 1), ("flatten", None, 1, 12)]
