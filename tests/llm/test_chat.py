import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.llm import chat
from starloom.llm.chat import block_matrix, chain, decode, format_chat, lines_of, op1_chat_format
from starloom.llm.common import table

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def best_score(markers, texts):
    """Over all role sequences."""
    _, steps = chat._steps(markers, texts)
    first = chat.START + chat.emission(chat.lines_of(markers[0], texts[0])[0])
    return max(
        first[path[0]] + sum(s[a, b] for s, a, b in zip(steps[1:], path, path[1:], strict=False))
        for path in itertools.product(range(3), repeat=len(steps))
    )


def score(markers, texts, roles):
    _, steps = chat._steps(markers, texts)
    first = chat.START + chat.emission(chat.lines_of(markers[0], texts[0])[0])
    return first[roles[0]] + sum(
        s[a, b] for s, a, b in zip(steps[1:], roles, roles[1:], strict=False)
    )


MARKERS = [None, "user", "what", None, "assistant", None]
TEXTS = ["You are kind", "hi\nhow?", "- list", "Human: x\nAI: y", "z" * 500, ""]


def test_viterbi_is_the_best_of_all_paths():
    for n in range(1, 7):
        _, roles = decode(MARKERS[:n], TEXTS[:n], None, None)
        assert score(MARKERS[:n], TEXTS[:n], roles) == best_score(MARKERS[:n], TEXTS[:n])


@pytest.mark.parametrize("size", [1, 2, 4])
def test_blocks_find_the_same_best_score(size):
    blocks = [(MARKERS[i : i + size], TEXTS[i : i + size]) for i in range(0, 6, size)]
    first = chat.START + chat.emission(lines_of(MARKERS[0], TEXTS[0])[0])
    _, steps = chat._steps(*blocks[0])
    for step in steps[1:]:
        first = (first[:, None] + step).max(axis=0)
    matrices = [block_matrix(*block) for block in blocks]
    roles = []
    for block, (entering, last) in zip(blocks, chain(matrices, first), strict=True):
        roles += decode(*block, entering, last)[1]
    assert score(MARKERS, TEXTS, roles) == best_score(MARKERS, TEXTS)


def test_given_roles_are_kept(spark):
    truth = {(r.conv_id, r.turn): r for r in table(spark, MEDIUM, "conversations").collect()}
    rows = op1_chat_format(spark, MEDIUM).collect()
    assert len(rows) == len(truth)
    for row in rows:
        given = truth[row.conv_id, row.turn]
        assert (row.role, row.text, row.piece) == (given.role, given.text.strip(), 0)
        assert row.rendered == f"<|{given.role}|>\n{given.text.strip()}\n<|end|>"


@pytest.mark.parametrize(("kept", "least"), [(2, 0.97), (1, 0.93), (0, 0.8)])
def test_hidden_roles_are_recovered(spark, kept, least):
    """Two, one or none of three markers are left."""
    rows = table(spark, MEDIUM, "conversations")
    truth = {(r.conv_id, r.turn): r.role for r in rows.collect()}
    place = F.pmod(F.xxhash64("conv_id", "turn"), F.lit(3))
    hidden = rows.withColumn("role", F.when(place < kept, F.col("role")))
    found = format_chat(hidden).filter("piece = 0").collect()
    assert np.mean([truth[r.conv_id, r.turn] == r.role for r in found]) >= least


def test_markers_in_the_text(spark):
    text = "### Human: hi\nthere\n[bot] yo\n**User**: bye\nnot a user: line"
    rows = spark.createDataFrame([(1, 0, text)], "conv_id long, turn long, text string")
    found = format_chat(rows, marker_col=None).orderBy("piece").collect()
    assert [(r.role, r.text) for r in found] == [
        ("user", "hi\nthere"),
        ("assistant", "yo"),
        ("user", "bye\nnot a user: line"),
    ]


def test_one_long_conversation_in_blocks(spark):
    rows = spark.range(3000).select(
        F.lit(1).alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") % 7 == 0, F.when(F.col("id") % 2 == 0, "user").otherwise("assistant")).alias("role"),
        F.lit("x").alias("text"),
    )
    whole = format_chat(rows, block_rows=10_000).orderBy("turn").collect()
    parts = format_chat(rows.repartition(9), block_rows=16).orderBy("turn").collect()
    assert [tuple(r) for r in whole] == [tuple(r) for r in parts]
    assert [r.role for r in whole] == ["user", "assistant"] * 1500


def test_nulls_ties_repeats_other_columns_and_empty(spark):
    schema = "conv_id long, turn long, role string, text string, place int, part string"
    rows = [
        (None, None, None, None, 1, ""),
        (1, 0, "user", "a", 1, ""),
        (1, 0, "user", "a", 1, ""),
        (1, 1, "", "", None, None),
        (2, 0, "assistant", "w " * 300_000, 1, ""),
    ]
    found = format_chat(spark.createDataFrame(rows, schema)).collect()
    assert len(found) == 5
    assert sorted(len(r.text) for r in found) == [0, 0, 1, 1, 599_999]
    assert format_chat(spark.createDataFrame([], schema)).count() == 0


def test_an_outvoted_marker_is_text(spark):
    text = "Context: is it so?\nand this?\nand that?\nand more?"
    rows = [(1, 1, "user", text), (2, 1, None, "User: hi\nAI: yes")]
    found = format_chat(spark.createDataFrame(rows, "conv_id int, turn int, role string, text string"))
    assert sorted((r.conv_id, r.piece, r.role, r.text, r.rendered) for r in found.collect()) == [
        (1, 0, "user", text, f"<|user|>\n{text}\n<|end|>"),
        (2, 0, "user", "hi", "<|user|>\nhi\n<|end|>"),
        (2, 1, "assistant", "yes", "<|assistant|>\nyes\n<|end|>"),
    ]


GIVEN = ["user", "assistant", "user", "what", None]
WORDS = ["Context: x\nAnswer:", "User: quoted\nmore", "Answer: two.", "AI: yes\nQuestion: so?", "Q: x"]


def test_viterbi_with_speakers_and_markers():
    """Rows with a known speaker whose lines name others."""
    for n in range(1, 6):
        _, roles = decode(GIVEN[:n], WORDS[:n], None, None)
        assert score(GIVEN[:n], WORDS[:n], roles) == best_score(GIVEN[:n], WORDS[:n])
    line = lines_of("user", "Answer: two.")[0]
    given, marker = lines_of("user", "two.")[0], lines_of(None, "Answer: two.")[0]
    evidence = [chat.emission(x) - chat.emission(given._replace(given=chat.MISSING, first=False)) for x in (given, marker)]
    both = chat.emission(line) - chat.emission(given._replace(given=chat.MISSING, first=False))
    assert (both == sum(evidence)).all()


PROMPT = "Context: birds fly.\nQuestion: do they?\nAnswer:"


@pytest.mark.parametrize(
    ("role", "text"),
    [
        ("user", PROMPT),
        ("user", "Answer: I chose option two."),
        ("user", "Instructions: be brief.\nQ: why?\nA: because."),
        ("assistant", "Question: which one do you mean?\nContext: I need more."),
        ("user", "Please go on:\nUser: hi\nAI: hello\nUser: bye"),
        ("system", "You are a bot.\nUser: will ask.\nAssistant: you answer."),
    ],
)
@pytest.mark.parametrize("alone", [True, False])
def test_known_speakers_keep_their_role_and_words(spark, role, text, alone):
    rows = [(1, 5, role, text)]
    if not alone:
        other = {"user": "assistant", "assistant": "user", "system": "user"}[role]
        rows += [(1, 4, None if role == "system" else other, "Fine."), (1, 6, other, "Good.")]
    found = format_chat(spark.createDataFrame(rows, "conv_id int, turn int, role string, text string"))
    (row,) = found.filter("turn = 5").collect()
    assert (row.role, row.text) == (role, text)


def test_words_open_turns_where_no_speaker_is_known(spark):
    rows = [(1, 1, None, "Question: what is it?\nAnswer: a bird.\nQuestion: which?\nAnswer: a crow.")]
    found = format_chat(spark.createDataFrame(rows, "conv_id int, turn int, role string, text string"))
    assert [(r.role, r.text) for r in found.orderBy("piece").collect()] == [
        ("user", "what is it?"),
        ("assistant", "a bird."),
        ("user", "which?"),
        ("assistant", "a crow."),
    ]
