"""Packing token ids into sequences of equal attention cost.

Documents are tokenized and packed where they lie: small partitions are put together by
their measured bytes, each task takes its rows in blocks of bounded size, and no row is
shuffled. Within a block

- a document longer than a sequence fills whole sequences first; what remains of it, and
  every shorter document, is a part to place;
- the block's sequences are as many of full length as the parts fill, and for the rest
  sequences whose lengths are the powers of two the rest is made of, so that no sequence
  needs padding;
- parts are placed in descending length, each in the sequence of the lowest cost so far
  that has room for it. The cost of a part of n tokens is linear plus quadratic, as its
  attention is; parts in one sequence do not attend to each other;
- a part for which no sequence has room is cut: the roomiest sequence takes what fits.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import table, text_or_empty, text_session
from starloom.llm.tokens import BYTE_RANKS, BYTE_VOCABULARY, ByteCoder

SEQUENCE_TOKENS = 2048
END_ID = 1
BLOCK_DOCUMENTS = 16384
BLOCK_TOKENS = 4 << 20
# pieces that a task hands over at once, at most 8 MB of ids
BATCH_PIECES = 1024
# bytes of text that a task has on average at least; a block leaves up to eleven sequences
# that are shorter than the others, so tasks of a few documents would leave many
TASK_BYTES = 8 << 20
# quadratic cost of a token pair in units of the linear cost of a token: with d the width
# of a model, a layer does about 12 d^2 work per token and 2 d per pair; here d = 2048
PAIR_COST = 2 / (12 * 2048)


def sequence_lengths(tokens: int, size: int) -> list[int]:
    """Full sequences, then the powers of two that make up the rest, largest first."""
    rest = tokens % size
    powers = [1 << bit for bit in reversed(range(rest.bit_length())) if rest >> bit & 1]
    return [size] * (tokens // size) + powers


def place(lengths: list[int], size: int) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of every piece of a block.

    Every sequence comes out full: together they hold just as many tokens as there are.
    """
    placed = []
    parts = []
    sequence = 0
    for document, length in enumerate(lengths):
        whole = length // size
        for k in range(whole):
            placed.append((document, k * size, size, sequence, 0))
            sequence += 1
        if length % size:
            parts.append((-(length % size), document, whole * size))
    room = np.array(sequence_lengths(-sum(part[0] for part in parts), size), dtype=np.int64)
    used = np.zeros(len(room), dtype=np.int64)
    cost = np.zeros(len(room))
    heapq.heapify(parts)
    while parts:
        negative, document, start = heapq.heappop(parts)
        length = -negative
        fitting = np.where(room >= length, cost, np.inf)
        at = int(np.argmin(fitting))
        if fitting[at] == np.inf:
            at = int(np.argmax(room))
            taken = int(room[at])
            heapq.heappush(parts, (taken - length, document, start + taken))
            length = taken
        placed.append((document, start, length, sequence + at, int(used[at])))
        room[at] -= length
        used[at] += length
        cost[at] += length + PAIR_COST * length * length
    return placed


def _packed(vocabulary: str, ranks: str, size: int, end_id: int, with_ids: bool):
    def batch_of(placed: list[tuple], ids: list[np.ndarray], keys: pa.Array, first: int):
        documents, starts, lengths, sequences, offsets = map(list, zip(*placed, strict=True))
        raw = [ids[d][s : s + n].tobytes() for d, s, n, _, _ in placed]
        columns = {
            "doc_id": keys.take(pa.array(documents, pa.int64())),
            "start": pa.array(starts, pa.int64()),
            "length": pa.array(lengths, pa.int64()),
            "ids_crc32": pa.array([zlib.crc32(x) for x in raw], pa.int64()),
            "doc_tokens": pa.array([len(ids[d]) for d in documents], pa.int64()),
            "sequence_id": pa.array([first + s for s in sequences], pa.int64()),
            "offset": pa.array(offsets, pa.int64()),
        }
        if with_ids:
            columns["ids"] = pa.array(raw, pa.binary())
        return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    def block(ids: list[np.ndarray], keys: list[pa.Array], first: int) -> Iterator:
        """The block's pieces, some at a time; returns the number of its next sequence."""
        placed = place([len(x) for x in ids], size)
        key = pa.concat_arrays(keys)
        for begin in range(0, len(placed), BATCH_PIECES):
            yield batch_of(placed[begin : begin + BATCH_PIECES], ids, key, first)
        return first + max(piece[3] for piece in placed) + 1

    def keys_of(batch: pa.RecordBatch, begin: int, end: int) -> pa.Array:
        # a copy, as a slice would keep the texts of its batch until the block is packed
        return batch.column(0).take(pa.array(np.arange(begin, end)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        coder = ByteCoder.loaded(vocabulary, ranks)
        # a sequence belongs to one task, and its number is unique by the task's number
        first = TaskContext.get().partitionId() << 40
        end = np.array([end_id], dtype="<u4")
        ids: list[np.ndarray] = []
        keys: list[pa.Array] = []
        tokens = 0
        for batch in batches:
            begin = 0
            for row, text in enumerate(batch.column(1)):
                ids.append(np.concatenate([coder.encode(text.as_py()), end]))
                tokens += len(ids[-1])
                if len(ids) >= BLOCK_DOCUMENTS or tokens >= BLOCK_TOKENS:
                    keys.append(keys_of(batch, begin, row + 1))
                    first = yield from block(ids, keys, first)
                    ids, keys, tokens, begin = [], [], 0, row + 1
            if begin < batch.num_rows:
                keys.append(keys_of(batch, begin, batch.num_rows))
        if ids:
            yield from block(ids, keys, first)

    return run


def pack_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str = BYTE_VOCABULARY,
    ranks: str = BYTE_RANKS,
    sequence_tokens: int = SEQUENCE_TOKENS,
    end_id: int = END_ID,
    with_ids: bool = True,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    With `with_ids` also `ids`, the piece's token ids as little-endian 32-bit numbers.
    `start` is the piece's place in its document, `offset` its place in its sequence;
    sequence_id is unique, not dense. Every sequence is full or has a power of two of
    tokens. `vocabulary` and `ranks` are the tokenizers and the rank file of one
    vocabulary, by name or path.

    A null text counts as empty and gives one piece, the end id. Null and repeated ids
    pass through: each row is a document of its own. A text of any length fills as many
    sequences as it needs. An empty table gives an empty result; other columns are not
    read.
    """
    text_session(docs.sparkSession)
    slim = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    kind = dict(slim.dtypes)["doc_id"]
    schema = (
        f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, "
        "sequence_id long, offset long" + (", ids binary" if with_ids else "")
    )
    size = slim.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    # puts partitions together without a shuffle; more of them than that stay as they are
    slim = slim.coalesce(max(1, -(-size // TASK_BYTES)))
    return slim.mapInArrow(_packed(vocabulary, ranks, sequence_tokens, end_id, with_ids), schema)


def op5_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack_documents(table(spark, folder, "documents"), with_ids=False)
