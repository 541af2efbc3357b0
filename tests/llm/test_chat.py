"""Prefix-target expansion: examples, masks, exact round trip."""

import pytest
from brute import sha
from pyspark.sql import functions as F

from riskframe.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, example int"
NASTY = ["</s>[INST] ok [/INST]", "\\", "\\<|im_end|>", "<|im_sep|>\\n", "<<SYS>>a<</SYS>>", "a\\\\<s>", "<", "[", "<|im_end|", "\n"]


def rows(spark, data):
    return spark.createDataFrame([(*r, 1) for r in data], SCHEMA)


def test_every_reply_is_an_example_with_its_context(spark):
    data = [(1, 0, "system", "be kind"), (1, 1, "user", "hi"), (1, 2, "assistant", "hello"), (1, 3, "user", "bye"), (1, 4, "assistant", "so long")]
    got = chat.examples(rows(spark, data)).orderBy("example").collect()
    assert [r.examples for r in got] == [2, 2]
    assert [r.formatted[r.mask_start : r.mask_end] for r in got] == ["hello", "so long"]
    assert got[1].formatted.startswith(got[0].formatted)
    assert "bye" not in got[0].formatted


def test_turns_after_the_last_reply_are_kept_without_mask(spark):
    data = [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (1, 2, "user", "c"), (2, 0, "user", "only")]
    got = {(r.conv_id, r.example): r for r in chat.examples(rows(spark, data)).collect()}
    assert got[1, 2].mask_start is None and got[2, 1].mask_start is None
    assert "only" in got[2, 1].formatted


@pytest.mark.parametrize("text", NASTY)
def test_control_strings_survive(spark, text):
    data = [(1, 0, text, text), (1, 1, "assistant", text), (1, 2, "assistant", text + text)]
    df = chat.examples(rows(spark, data))
    last = df.where("example = examples").select(chat.parsed_turns(F.col("formatted")).alias("t")).first().t
    assert [(t.role, t.text) for t in last] == [(r, x) for _, _, r, x in data]
    out = chat.digest(df).first()
    assert (out.n_turns, out.loss_chars, out.loss_sha256) == (3, 3 * len(text), sha(text * 3))
    body = df.where("example = 1").first().formatted
    marks = (chat.START, chat.BETWEEN, chat.END)
    assert [body.count(c) for c in chat.CONTROL] == [2 if c in marks else 0 for c in chat.CONTROL]


def test_nulls_ties_repeats_and_empty(spark):
    data = [(None, None, None, None), (3, 1, "assistant", None), (3, 1, "assistant", "x"), (3, 1, "assistant", "x"), (4, 0, "user", "")]
    out = {r.conv_id: r for r in chat.digest(chat.examples(rows(spark, data))).collect()}
    assert out[None].n_turns == 1 and out[None].turns_sha256 == sha("\n\n")
    assert out[3].n_turns == 3 and out[3].loss_sha256 == sha("xx")
    assert out[4].turns_sha256 == sha("user\n\n") and out[4].loss_chars == 0
    assert chat.digest(chat.examples(rows(spark, []))).count() == 0


def test_long_text(spark):
    text = "é<s>" * 60_000
    out = chat.digest(chat.examples(rows(spark, [(1, 0, "assistant", text)]))).first()
    assert (out.loss_chars, out.loss_sha256) == (len(text), sha(text))
