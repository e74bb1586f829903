"""Token ids in compact binary blocks.

Documents are tokenized where they are read, their ids range partitioned and sorted by
document id, and written block by block as Parquet rows: the writer's commit protocol makes the files safe against lost and repeated
tasks on any file system. A block holds whole documents, about a million ids, and can be
decoded by itself. Its payload is, in little-endian order,

    magic    4 bytes, b"TKB1"
    n, v     two 32-bit numbers: the ids, and the different ids among them
    table    v 32-bit numbers: the different ids, the most frequent first, ties by id
    control  ceil(n / 4) bytes: 2 bits an id, the first in the low bits, bytes minus one
    data     n ranks of 1 to 4 bytes each: the ids' places in the table

so the 256 most frequent ids of a block take one byte each. Frequencies are counted over
all ids of the block. Control bytes lie apart from the data: a table of 256 entries tells
the lengths of four ranks at once, and numpy decodes a block without a loop.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.llm.common import BROADCAST_BYTES, table, text_or_empty, text_session
from starloom.llm.tokens import WORD_VOCABULARY, WordCoder
from starloom.operators.lookup import look_up
from starloom.workspace import Workspace

END_ID = 2
BLOCK_TOKENS = 1 << 20
MAGIC = b"TKB1"


def encode_block(ids: np.ndarray) -> bytes:
    counts = np.bincount(ids)
    present = np.flatnonzero(counts)
    order = present[np.lexsort((present, -counts[present]))]
    rank_of = np.zeros(len(counts), dtype="<u4")
    rank_of[order] = np.arange(len(order))
    ranks = rank_of[ids]
    extra = (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    fours = np.zeros(-(-len(ids) // 4) * 4, dtype=np.uint8)
    fours[: len(ids)] = extra
    fours = fours.reshape(-1, 4)
    control = fours[:, 0] | fours[:, 1] << 2 | fours[:, 2] << 4 | fours[:, 3] << 6
    used = np.arange(4) <= extra[:, None]
    data = ranks.view(np.uint8).reshape(-1, 4)[used]
    head = np.array([len(ids), len(order)], dtype="<u4").tobytes()
    return b"".join([MAGIC, head, order.astype("<u4").tobytes(), control.tobytes(), data.tobytes()])


def decode_block(payload: bytes) -> np.ndarray:
    if payload[:4] != MAGIC:
        raise ValueError("not a block of token ids")
    n, v = np.frombuffer(payload, "<u4", 2, 4)
    order = np.frombuffer(payload, "<u4", v, 12)
    begin = 12 + 4 * int(v)
    control = np.frombuffer(payload, np.uint8, -(-int(n) // 4), begin)
    data = np.frombuffer(payload, np.uint8, offset=begin + len(control))
    # the lengths of the four ranks of every possible control byte
    lengths = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3).astype(np.uint8) + 1
    used = np.arange(4) < lengths[control].reshape(-1)[:n, None]
    ranks = np.zeros((int(n), 4), dtype=np.uint8)
    ranks[used] = data
    return order[ranks.view("<u4").reshape(-1)]


def _encoded(vocabulary: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = WordCoder.loaded(vocabulary)
        end = np.array([end_id], dtype=coder.kind)
        for batch in batches:
            codes = [np.concatenate([code, end]) for code in coder.encode(batch.column(2))]
            columns = {
                "doc_id": batch.column(0),
                "tie": batch.column(1),
                "n_tokens": pa.array([len(code) for code in codes], pa.int64()),
                "ids": pa.array([code.tobytes() for code in codes], pa.binary()),
            }
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return run


def _blocks(vocabulary: str, block_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        # the words that this worker learned are not needed beside the sorted rows
        WordCoder.forget(vocabulary)
        part = TaskContext.get().partitionId()
        ids: list[np.ndarray] = []
        keys: list[pa.Array] = []
        number = tokens = 0

        def block() -> pa.RecordBatch:
            lengths = [len(x) for x in ids]
            columns = {
                "part": pa.array([part], pa.int64()),
                "block": pa.array([number], pa.int64()),
                "n_tokens": pa.array([sum(lengths)], pa.int64()),
                "doc_ids": pa.ListArray.from_arrays([0, len(ids)], pa.concat_arrays(keys)),
                "lengths": pa.array([lengths], pa.list_(pa.int64())),
                "payload": pa.array([encode_block(np.concatenate(ids))], pa.binary()),
            }
            return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

        for batch in batches:
            begin = 0
            rows = zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)
            for row, (n, raw) in enumerate(rows):
                ids.append(np.frombuffer(raw, f"<u{len(raw) // n}"))
                tokens += n
                if tokens >= block_tokens:
                    keys.append(batch.column(0).slice(begin, row + 1 - begin))
                    yield block()
                    ids, keys, tokens = [], [], 0
                    number, begin = number + 1, row + 1
            if begin < batch.num_rows:
                keys.append(batch.column(0).slice(begin))
        if ids:
            yield block()

    return run


def write_token_files(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str = WORD_VOCABULARY,
    end_id: int = END_ID,
    block_tokens: int = BLOCK_TOKENS,
    workspace: Workspace | None = None,
) -> None:
    """Write the ids of all documents, each with `end_id` appended, in ascending id order.

    A null text counts as empty and gives the end id alone; null ids come first; equal ids
    go by a hash of the text, and repeated rows are each written. A document longer than a
    block makes a block of its own. An empty table writes no block; other columns are not
    read.
    """
    workspace = workspace or Workspace(text_session(docs.sparkSession))
    text = text_or_empty(text_col)
    slim = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("tie"), text.alias("text"))
    # the hash also spreads an id that many rows share
    order = [F.col("doc_id").asc_nulls_first(), F.col("tie")]
    kind = dict(slim.dtypes)["doc_id"]
    # stored, as the ranges are drawn from a first pass over the rows
    encoded = workspace.save(
        slim.mapInArrow(
            _encoded(vocabulary, end_id), f"doc_id {kind}, tie long, n_tokens long, ids binary"
        ),
        "encoded",
    )
    blocks = (
        encoded.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("doc_id", "n_tokens", "ids")
        .mapInArrow(
            _blocks(vocabulary, block_tokens),
            f"part long, block long, n_tokens long, doc_ids array<{kind}>, "
            "lengths array<long>, payload binary",
        )
    )
    # the payload is dense already
    blocks.write.option("compression", "none").parquet(path)
    workspace.release(encoded)


def _read(with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                part, block, keys, lengths, payload = (column[row] for column in batch.columns)
                lengths = np.array(lengths.as_py(), dtype=np.int64)
                ends = np.cumsum(lengths)
                ids = decode_block(payload.as_py())
                raw = [ids[e - n : e].tobytes() for e, n in zip(ends, lengths, strict=True)]
                columns = {
                    "doc_id": keys.values,
                    "part": pa.array([part.as_py()] * len(raw), pa.int64()),
                    "block": pa.array([block.as_py()] * len(raw), pa.int64()),
                    "within": pa.array(ends - lengths, pa.int64()),
                    "n_tokens": pa.array(lengths, pa.int64()),
                    "ids_crc32": pa.array([zlib.crc32(x) for x in raw], pa.int64()),
                }
                if with_ids:
                    columns["ids"] = pa.array(raw, pa.binary())
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return run


def read_token_files(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """One row per document of the files: doc_id, start, n_tokens, ids_crc32 and `ids`.

    `start` counts the ids of all documents before; `ids` are little-endian 32-bit numbers.
    """
    blocks = text_session(spark).read.parquet(path)
    kind = dict(blocks.dtypes)["doc_ids"].removeprefix("array<").removesuffix(">")
    schema = (
        f"doc_id {kind}, part long, block long, within long, n_tokens long, ids_crc32 long"
        + (", ids binary" if with_ids else "")
    )
    # one row per file part: as many as there were tasks, whatever the number of rows
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        blocks.groupBy("part")
        .agg(F.sum("n_tokens").alias("size"))
        .select("part", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("part_start"))
    )
    inside = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        blocks.select("part", "block", "n_tokens")
        .join(F.broadcast(parts), "part")
        .select(
            "part",
            "block",
            (F.col("part_start") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).alias("first"),
        )
    )
    decoded = blocks.select("part", "block", "doc_ids", "lengths", "payload")
    decoded = decoded.mapInArrow(_read(with_ids), schema)
    return look_up(decoded, starts, ["part", "block"], BROADCAST_BYTES).select(
        "doc_id",
        (F.col("first") + F.col("within")).alias("start"),
        "n_tokens",
        "ids_crc32",
        *(["ids"] if with_ids else []),
    )


def op6_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = Workspace(spark).fresh_path("token-files")
    docs = table(spark, folder, "documents")
    write_token_files(docs, path)
    if not docs.isEmpty():
        return read_token_files(spark, path, with_ids=False)
    return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
