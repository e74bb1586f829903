"""Chat formatting: roles by a hidden Markov model, turns in one canonical form.

A transcript is the lines of its rows in order. The states are the roles; a line emits the
speaker given with its row, the marker written in front of it, each if there is one, and a
few features of its text. Roles tend to alternate from row to row and to stay from line to
line within a row. The most likely roles are found by Viterbi, so a missing or unknown
speaker is filled from its neighbours, and a wrong one can be outvoted by two.

A row's known speaker and a marker in its text are separate evidence. Words that prompts
also use (`Context:`, `Answer:`) say little, and a row with a known speaker is one turn
unless much speaks against it. A marker is cut from the text only where it names the role
that was found and opens a turn.

A long conversation is not one task's work. Rows are range partitioned and sorted, and
runs of one conversation are cut into blocks of at most `BLOCK_ROWS` rows. Viterbi is a
product of matrices with (max, +) in place of (+, *): every block gives the matrix of its
best scores from each role before it to each role at its end. For conversations of
several blocks these small matrices are scanned forward for the scores that enter a block
and backward for the role it ends in; then each block finds its own path. Scores are whole
numbers, so the order of the additions cannot change the result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import BROADCAST_BYTES, table, text_or_empty, text_session
from starloom.operators.lookup import look_up, measured_bytes
from starloom.workspace import Workspace

ROLES = ("system", "user", "assistant")
BLOCK_ROWS = 4096
BLOCK_BYTES = 8 << 20

# What speakers are called
SPEAKERS = {
    "system": "system developer instruction instructions context",
    "user": "user human customer client question prompter q you",
    "assistant": "assistant ai bot model gpt agent chatbot answer a",
}
# Those of them that are words of ordinary prompts too
WORDS_TOO = frozenset("context question answer instruction instructions q a you model".split())
_ROLE_OF = {name: place for place, role in enumerate(ROLES) for name in SPEAKERS[role].split()}
_NAME = "(" + "|".join(sorted(_ROLE_OF, key=len, reverse=True)) + ")"
# in front of a line: `User:`, `**Bot**:`, `>> AI:`; `[user]`; `<|user|>`; a heading
_MARKERS = [
    re.compile(r"\s{0,3}" + form, re.IGNORECASE)
    for form in (
        rf"(?:#{{1,4}}\s*|\*{{1,2}}|>>\s*)?{_NAME}\s*\*{{0,2}}\s*:\*{{0,2}}(?:\s+|$)",
        rf"\[{_NAME}\]:?\s*",
        rf"<\|{_NAME}\|>\s*",
        rf"<\|im_start\|>{_NAME}\s*$",
        rf"#{{1,4}}\s*{_NAME}\s*$",
    )
]


def _scores(probabilities) -> np.ndarray:
    return np.rint(1000 * np.log(np.array(probabilities, dtype=float))).astype(np.int64)


# rows: system, user, assistant; a probability each, as scores of a thousandth of a nat
START = _scores([0.3, 0.6, 0.1])
NEXT_ROW = _scores([[0.05, 0.80, 0.15], [0.03, 0.12, 0.85], [0.03, 0.85, 0.12]])
NEXT_LINE = _scores([[0.98, 0.01, 0.01], [0.01, 0.98, 0.01], [0.01, 0.01, 0.98]])
# speaker or marker: names system, user, assistant, an unknown speaker, or is missing
MARKED = _scores(
    [
        [0.90, 0.015, 0.015, 0.02, 0.05],
        [0.003, 0.93, 0.007, 0.02, 0.04],
        [0.003, 0.007, 0.93, 0.02, 0.04],
    ]
)
# a marker that is a word of prompts and answers as well
HINTED = _scores([[0.60, 0.20, 0.20], [0.15, 0.70, 0.15], [0.10, 0.15, 0.75]])
UNKNOWN, MISSING = len(ROLES), len(ROLES) + 1
# features, present or not: a question, a long line, a list or code, an instruction
_FEATURES = (
    (re.compile(r"\?\s*$"), (0.02, 0.35, 0.08)),
    (re.compile(r"^.{400,}", re.DOTALL), (0.05, 0.05, 0.30)),
    (re.compile(r"^\s*(?:[-*•]\s|\d+[.)]\s|```)"), (0.15, 0.05, 0.30)),
    (re.compile(r"^\s*(?:you are|you must|your task|act as)\b", re.IGNORECASE), (0.6, 0.03, 0.01)),
)
_PRESENT = [_scores(p) for _, p in _FEATURES]
_ABSENT = [_scores([1 - x for x in p]) for _, p in _FEATURES]


class Line(NamedTuple):
    """A line of a row: without its marker and whole, and what it says about its speaker."""

    text: str
    whole: str
    # the row's speaker, and the marker in front of the line
    given: int
    marker: int
    # whether the marker is a word of prompts too
    word: bool
    first: bool

    @property
    def opens(self) -> bool:
        """Whether a turn may well begin here, as with a new row."""
        return self.first or (self.marker != MISSING and self.given >= UNKNOWN)


def lines_of(marker: str | None, text: str) -> list[Line]:
    given = MISSING
    if marker is not None and marker.strip():
        given = _ROLE_OF.get(marker.strip().lower(), UNKNOWN)
    lines = []
    for place, line in enumerate(text.split("\n")):
        found = next(filter(None, (form.match(line) for form in _MARKERS)), None)
        if found:
            name = found[1].lower()
            named = (line[found.end() :], line, given, _ROLE_OF[name], name in WORDS_TOO)
        else:
            named = (line, line, given, MISSING, False)
        lines.append(Line(*named, place == 0))
    return lines


def emission(line: Line) -> np.ndarray:
    scores = np.zeros(len(ROLES), dtype=np.int64)
    marked = line.marker != MISSING
    if line.first or marked:
        # within a row a missing marker is the rule and says nothing; where the line has one,
        # that no speaker is given says nothing either
        if line.given != MISSING or not marked:
            scores += MARKED[:, line.given]
        if marked:
            scores += (HINTED if line.word else MARKED)[:, line.marker]
    for (pattern, _), present, absent in zip(_FEATURES, _PRESENT, _ABSENT, strict=True):
        scores += present if pattern.search(line.text) else absent
    return scores


def _steps(markers: list, texts: list) -> tuple[list[tuple[int, Line]], list[np.ndarray]]:
    lines = [
        (row, line)
        for row, (marker, text) in enumerate(zip(markers, texts, strict=True))
        for line in lines_of(marker, text)
    ]
    steps = [
        (NEXT_ROW if line.opens else NEXT_LINE) + emission(line)[None, :] for _, line in lines
    ]
    return lines, steps


def block_matrix(markers: list, texts: list) -> np.ndarray:
    """Best scores from each role before the block to each role at its end."""
    _, steps = _steps(markers, texts)
    matrix = steps[0]
    for step in steps[1:]:
        matrix = (matrix[:, :, None] + step[None, :, :]).max(axis=1)
    return matrix


def decode(markers: list, texts: list, entering: np.ndarray | None, last: int | None) -> tuple:
    """Lines of a block and their roles.

    `entering` are the scores of the roles before the block, None at the start of a
    conversation; `last` is the role of its last line, None for the best. Ties go to the
    role that comes first.
    """
    lines, steps = _steps(markers, texts)
    if entering is None:
        scores = START + emission(lines[0][1])
    else:
        scores = (entering[:, None] + steps[0]).max(axis=0)
    back = []
    for step in steps[1:]:
        paths = scores[:, None] + step
        back.append(paths.argmax(axis=0))
        scores = paths.max(axis=0)
    role = int(scores.argmax()) if last is None else last
    roles = [role]
    for before in reversed(back):
        role = int(before[role])
        roles.append(role)
    return lines, roles[::-1]


def chain(matrices: list[np.ndarray], first: np.ndarray) -> list[tuple[np.ndarray | None, int]]:
    """For every block of a conversation, the scores entering it and its last role.

    `first` are the scores at the end of the first block.
    """
    entering: list[np.ndarray | None] = [None]
    scores = first
    for matrix in matrices[1:]:
        entering.append(scores)
        scores = (scores[:, None] + matrix).max(axis=0)
    last = int(scores.argmax())
    ends = [last]
    for k in range(len(matrices) - 1, 0, -1):
        last = int((entering[k] + matrices[k][:, last]).argmax())
        ends.append(last)
    return list(zip(entering, reversed(ends), strict=True))


def _blocks(block_rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        number = 0
        held: list[pa.RecordBatch] = []
        rows = size = 0

        def block() -> pa.RecordBatch:
            whole = pa.Table.from_batches(held).combine_chunks()
            conversation = whole.column("conv").chunk(0).slice(0, 1)
            columns = {
                "conv": conversation,
                "part": pa.array([part], pa.int64()),
                "block": pa.array([number], pa.int64()),
            }
            for name in ("place", "marker", "text"):
                values = whole.column(name).chunk(0)
                columns[f"{name}s"] = pa.ListArray.from_arrays([0, len(values)], values)
            return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

        open_conversation: object = None
        for batch in batches:
            conversations = batch.column(0).to_pylist()
            sizes = [len(text) for text in batch.column(3).to_pylist()]
            begin = 0
            for row, conversation in enumerate(conversations):
                new = rows and conversation != open_conversation
                if new or rows >= block_rows or (rows and size + sizes[row] > BLOCK_BYTES):
                    held.append(batch.slice(begin, row - begin))
                    yield block()
                    held, rows, size, begin = [], 0, 0, row
                    number += 1
                open_conversation = conversation
                rows += 1
                size += sizes[row]
            held.append(batch.slice(begin))
        if rows:
            yield block()

    return run


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """conv, part, block, the block's matrix, and its end scores as a first block."""
    for batch in batches:
        matrices, firsts = [], []
        for markers, texts in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True):
            lines, steps = _steps(markers, texts)
            matrices.append(block_matrix(markers, texts).reshape(-1).tolist())
            scores = START + emission(lines[0][1])
            for step in steps[1:]:
                scores = (scores[:, None] + step).max(axis=0)
            firsts.append(scores.tolist())
        scores = pa.list_(pa.int64())
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:3], pa.array(matrices, scores), pa.array(firsts, scores)],
            ["conv", "part", "block", "matrix", "first"],
        )


def _scan(blocks: pd.DataFrame) -> pd.DataFrame:
    blocks = blocks.sort_values(["part", "block"])
    matrices = [np.array(m, dtype=np.int64).reshape(3, 3) for m in blocks["matrix"]]
    found = chain(matrices, np.array(blocks["first"].iloc[0], dtype=np.int64))
    return pd.DataFrame(
        {
            "part": blocks["part"].to_numpy(),
            "block": blocks["block"].to_numpy(),
            "entering": [None if scores is None else scores.tolist() for scores, _ in found],
            "last": [last for _, last in found],
        }
    )


def render(role: str, text: str) -> str:
    return f"<|{role}|>\n{text}\n<|end|>"


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in range(batch.num_rows):
            conv, _, _, places, markers, texts, entering, last = (
                column[block] for column in batch.columns
            )
            entering = entering.as_py()
            lines, roles = decode(
                markers.as_py(),
                texts.as_py(),
                None if entering is None else np.array(entering, dtype=np.int64),
                last.as_py(),
            )
            # a turn is a run of one role within a row
            turns: list[list] = []
            for (row, line), role in zip(lines, roles, strict=True):
                goes_on = bool(turns) and turns[-1][0] == row and turns[-1][1] == role
                # a word is text in a row whose speaker is known, and so is an outvoted marker
                named = role == line.marker and not (line.word and line.given < UNKNOWN)
                text = line.text if named and not goes_on else line.whole
                if goes_on:
                    turns[-1][3].append(text)
                else:
                    piece = turns[-1][2] + 1 if turns and turns[-1][0] == row else 0
                    turns.append([row, role, piece, [text]])
            rows = pa.array([turn[0] for turn in turns], pa.int64())
            bodies = ["\n".join(turn[3]).strip() for turn in turns]
            names = [ROLES[turn[1]] for turn in turns]
            columns = {
                "conv": pa.array([conv.as_py()] * len(turns), batch.schema.field("conv").type),
                "place": places.values.take(rows),
                "piece": pa.array([turn[2] for turn in turns], pa.int64()),
                "role": pa.array(names, pa.string()),
                "text": pa.array(bodies, pa.string()),
                "rendered": pa.array(list(map(render, names, bodies)), pa.string()),
            }
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def format_chat(
    rows: DataFrame,
    conv_col: str = "conv_id",
    order_col: str = "turn",
    marker_col: str | None = "role",
    text_col: str = "text",
    workspace: Workspace | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """One row per turn: conv_id, turn, piece, role, text, rendered.

    A row gives one turn, or several if speaker markers in its lines (`User:`, `### AI:`,
    `[bot]`, ...) change the role; `piece` numbers them. `marker_col` names the speaker as
    the source has it, or is None. `text` is without outer white space and without
    the marker that names its role and opens it; other markers are text, and so are words
    like `Answer:` where the row's speaker is known. `rendered` is the canonical form.

    A null or empty text gives one turn with an empty text. A null marker is a missing one,
    an unknown name an unknown one. Null conversations are one conversation; null places
    come first; rows with the same place go by marker and a hash of the text, and repeated
    rows are turns of their own. An empty table gives an empty result; other columns are
    not read.
    """
    workspace = workspace or Workspace(rows.sparkSession)
    text_session(rows.sparkSession)
    marker = F.col(marker_col).cast("string") if marker_col else F.lit(None).cast("string")
    slim = rows.select(
        F.col(conv_col).alias("conv"),
        F.col(order_col).alias("place"),
        marker.alias("marker"),
        text_or_empty(text_col).alias("text"),
    )
    kinds = dict(slim.dtypes)
    # the whole order decides the range, so a long conversation is spread
    order = ["conv", "place", "marker", F.xxhash64("text")]
    blocks = (
        slim.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .mapInArrow(
            _blocks(block_rows),
            f"conv {kinds['conv']}, part long, block long, places array<{kinds['place']}>, "
            "markers array<string>, texts array<string>",
        )
    )
    blocks = workspace.save(blocks, "blocks")
    several = workspace.save(
        blocks.groupBy("conv").agg(F.count("*").alias("blocks")).filter("blocks > 1").select("conv"),
        "several",
    )
    if measured_bytes(several) <= BROADCAST_BYTES:
        several = F.broadcast(several)
    long = blocks.select("conv", "part", "block", "markers", "texts")
    same = long["conv"].eqNullSafe(several["conv"])
    matrices = long.join(several, same, "left_semi").mapInArrow(
        _matrices,
        f"conv {kinds['conv']}, part long, block long, matrix array<long>, first array<long>",
    )
    # a group has one small row per block, not per line
    chained = matrices.groupBy("conv").applyInPandas(
        _scan, "part long, block long, entering array<long>, last int"
    )
    chained = workspace.save(chained, "chained")
    placed = look_up(blocks, chained, ["part", "block"], BROADCAST_BYTES).select(
        "conv", "part", "block", "places", "markers", "texts", "entering", "last"
    )
    return placed.mapInArrow(
        _turns,
        f"conv {kinds['conv']}, place {kinds['place']}, piece long, role string, text string, "
        "rendered string",
    ).withColumnsRenamed({"conv": "conv_id", "place": "turn"})


def op1_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    return format_chat(table(spark, folder, "conversations"))
