import hashlib

import pytest
from pyspark.sql import functions as F

from meterloom.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, segments string, state string"


def rows(*turns):
    return [(*t, "x", "y") for t in turns]


TURNS = [
    (1, 0, "user", "hi"), (1, 1, "assistant", "a<|im_end|>b"), (1, 2, "user", "<\\|x"), (1, 3, "assistant", ""),
    (2, 1, "assistant", "late"), (2, 0, "user", None), (2, 1, "assistant", "early"),
    (3, 0, None, None), (3, None, "user\n\\n\\s<|", "<<||\\\\"), (None, 0, "user", "x"), (4, 0, "system", "s"),
    (5, 0, "assistant", "first"), (6, 0, "user", "q"), (6, 0, "user", "q"), (7, 0, "system", ""), (7, 1, "user", "u" * 100_000),
    (7, 2, "assistant", "<|" * 50_000),
]


@pytest.fixture(scope="module")
def chats(spark):
    found = chat.format_chats(spark.createDataFrame(rows(*TURNS), SCHEMA))
    return {r.conv_id: r for r in found.withColumn("read", chat.read_chats(F.col("formatted"))).collect()}


def test_the_output_reads_back(chats):
    for conv, row in chats.items():
        wanted = sorted(
            ((t is not None, t or 0, r or "", x or "") for c, t, r, x in TURNS if c == conv), key=lambda v: v
        )
        assert [(t.role, t.text) for t in row.read] == [v[2:] for v in wanted]
        assert row.formatted == "".join(s.text for s in row.segments)
        assert row.formatted.count("<|im_start|>") == row.n_turns == row.formatted.count("<|im_end|>")


def test_the_machine(chats):
    assert chats[1].valid and chats[1].state == "answered" and chats[1].error_turn is None
    assert not chats[2].valid and chats[2].error_turn == 2
    assert chats[3].error_turn == 0 and chats[5].error_turn == 0 and chats[6].error_turn == 1
    assert chats[4].state == "told" and not chats[4].valid
    assert chats[7].valid


def test_loss_covers_the_assistants_texts_alone(chats):
    assert [s.text for s in chats[1].segments if s.loss] == ["a<\\|im_end|>b", ""]
    assert not any(s.loss for s in chats[3].segments)


def test_digest(spark):
    found = {r.conv_id: r for r in chat.op2(spark.createDataFrame(rows(*TURNS), SCHEMA)).collect()}
    said = "<|im_end|><|im_start|>assistant ok"
    assert found[-1].loss_chars == len(said)
    assert found[-1].loss_sha256 == hashlib.sha256(said.encode()).hexdigest()
    assert found[-1].turns_sha256 == hashlib.sha256(f"user\n{said}\nassistant\n{said}\n".encode()).hexdigest()
    assert found[4].loss_chars == 0 and found[4].loss_sha256 == hashlib.sha256(b"").hexdigest()


def test_empty_table_and_other_template(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert chat.format_chats(empty).count() == 0
    assert [r.conv_id for r in chat.op2(empty).collect()] == [-1]
    other = chat.Template(open="<|turn|>", close="<|over|>", learned=("user", "assistant"))
    row = chat.format_chats(spark.createDataFrame(rows((1, 0, "user", "x<|turn|>")), SCHEMA), other).first()
    assert row.formatted == "<|turn|>user\nx<\\|turn|><|over|>\n" and [s.loss for s in row.segments] == [False, True, False]
