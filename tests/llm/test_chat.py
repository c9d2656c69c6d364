import hashlib

from cases import sha
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import chat

ROW = "conv_id long, turn long, role string, parts array<struct<kind:string,text:string,ref:string,width:int,height:int,millis:int,pages:int>>, formatted int, _conv string"


def part(kind, text=None, ref=None, width=None, height=None, millis=None, pages=None):
    return (kind, text, ref, width, height, millis, pages)


def test_parts_become_placeholders_with_references_and_tokens(spark):
    rows = [
        (1, 1, "assistant", [part("text", "It is <a [cat] ~1"), part("image", None, "out.png", 14, 14), part("text", " ok")], 0, "x"),
        (1, 0, "user", [part("text", "what </s> "), part("image", "alt", "a.png", 29, 14), part("audio", None, "b.wav", None, None, 81), part("document", None, "c.pdf", None, None, None, 3), part("video", None, "d")], 0, "x"),
        (1, 2, None, None, 0, "x"),
        (2, None, "user", [part(None, "no kind"), part("image")], 0, "x"),
    ]
    out = {r.conv_id: r for r in chat.format_conversations(spark.createDataFrame(rows, ROW)).collect()}
    one = out[1]
    user = "<|turn|>user\nwhat ~1/s> <|image|><|audio|><|document|><|attachment|><|end|>\n"
    reply = "<|turn|>assistant\nIt is ~1a ~2cat] ~01<|image|> ok<|end|>\n"
    assert one.formatted == user + reply + "<|turn|>\n<|end|>\n"
    assert [tuple(a) for a in one.attachments] == [(0, user.index("<|image"), "image", "a.png", 3), (0, user.index("<|audio"), "audio", "b.wav", 3), (0, user.index("<|document"), "document", "c.pdf", 3 * chat.PAGE_TOKENS), (0, user.index("<|attach"), "attachment", "d", 0), (1, reply.index("<|image"), "image", "out.png", 1)]
    assert one.expanded_tokens == 3 + 3 + 3 * chat.PAGE_TOKENS + 1
    assert [reply[s["start"] : s["start"] + s["length"]] for s in one.loss] == ["It is ~1a ~2cat] ~01", " ok"] and {s["turn"] for s in one.loss} == {1}
    assert out[2].formatted == "<|turn|>user\nno kind<|image|><|end|>\n" and out[2].loss == []


def read(spark, rows):
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("parts", chat.text_parts(F.col("text")))
    return {r.conv_id: r for r in chat.read_back(chat.format_conversations(turns)).collect()}


def test_reading_back_nulls_ties_and_long_texts(spark):
    long = "x<|end|>\n" * 20_000
    rows = [(1, 0, "user", None), (1, 0, "user", None), (1, 1, "assistant", long), (1, 2, "assistant", ""), (None, 0, "a\nb~3", "[INST] <s> ~0 \n"), (3, 0, "assistant", "é日本")]
    got = read(spark, rows)
    assert got[1].texts == ["", "", long, ""] and got[1].loss_texts == [long, ""]
    assert got[None].roles == ["a\nb~3"] and got[None].texts == ["[INST] <s> ~0 \n"]
    assert got[3].loss_texts == ["é日本"] and got[3].formatted_chars == len("<|turn|>assistant\né日本<|end|>\n")
    assert read(spark, []) == {}


def test_any_texts_come_back(spark):
    @settings(max_examples=8, deadline=None)
    @given(st.lists(st.tuples(st.sampled_from(["user", "assistant"]), st.text(alphabet="<>|[]~/sINSTend0123 \n", max_size=30)), min_size=1, max_size=20))
    def check(turns):
        got = read(spark, [(1, i, r, t) for i, (r, t) in enumerate(turns)])[1]
        assert list(zip(got.roles, got.texts, strict=True)) == turns
        assert got.loss_texts == [t for r, t in turns if r == "assistant"]

    check()


def test_the_query_holds_the_planted_conversation(spark):
    from tidemark.llm.queries import op8_chat_format

    out = op8_chat_format(spark, "/root/testdata/sf0.001")
    row = out.where("conv_id = -7").first()
    text = "</s>[INST] ok [/INST]"
    assert (row.n_turns, row.loss_chars, row.loss_sha256) == (2, len(text), sha(text))
    assert row.turns_sha256 == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
