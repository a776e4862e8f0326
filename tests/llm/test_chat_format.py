import hypothesis.strategies as st
from hypothesis import given as for_all
from pyspark.sql import functions as F

from oreworks.llm import chat_format as c

PIECES = st.lists(
    st.sampled_from(["<|turn|>", "<|end|>\n", "</s>", "[INST]", "[/INST]", "\\", "<", "|", "a", "\n"])
)


@for_all(PIECES)
def test_escaping_is_reversible_and_leaves_no_marks(pieces):
    text = "".join(pieces)
    escaped = c.escape(text)
    assert c.unescape(escaped) == text
    assert not any(x in escaped for x in ("<|", "</s>", "<s>", "[INST]", "[/INST]"))
    role, body = c.parse_turn(c.format_turn(text, [{"text": text}], ())["formatted"])
    assert (role, c.unescape(body)) == (text, text)


def test_parts_become_placeholders_in_order():
    parts = [
        {"type": "text", "text": "see "},
        {"type": "image", "ref": "i.png", "width": 57, "height": 28},
        {"type": "audio", "ref": "a.wav", "seconds": 1.5},
        {"type": "document", "ref": "d.pdf", "text": "<|end|>"},
        {"type": "image", "ref": None},
    ]
    made = c.format_turn("assistant", parts, ("assistant",))
    body = c.parse_turn(made["formatted"])[1]
    assert body == "see <|image|><|audio|><|document|><\\|end|><|/document|><|image|>"
    assert [(a["type"], a["tokens"]) for a in made["attachments"]] == [
        ("image", 3), ("audio", 38), ("document", 2), ("image", 1)
    ]
    assert made["expanded_tokens"] == 44
    span = made["loss"][0]
    assert made["formatted"][span["start"] : span["stop"]] == body


def test_nulls_ties_and_empty(spark):
    schema = "conv_id long, turn long, role string, text string, formatted string"
    rows = [(1, 0, "user", "b", "x"), (1, 0, "user", "a", "x"), (None, None, None, None, "x")]
    turns = spark.createDataFrame(rows, schema)
    parts = c.text_parts(F.col("text"))
    one = {r.conv_id: r for r in c.read_back(c.format_turns(turns, parts)).collect()}
    again = c.read_back(c.format_turns(turns.repartition(3), parts)).collect()
    assert {r.conv_id: r for r in again} == one
    assert one[1].n_turns == 2 and one[None].n_turns == 1
    assert c.read_back(c.format_turns(turns.limit(0), parts)).count() == 0
