"""CSV files whose quoted fields hold line breaks, read by several tasks per file.

Whether a line begins a record depends on all quotes before it in its file. So the lines
are read twice:

1. Each block (the part of a file one task reads) tells whether its quotes are odd in number,
   and the pieces of records at its ends, both for a block that begins within a quoted field
   and for one that does not. A prefix sum over the blocks of a file tells which of the two
   holds. Only these pieces, at most two a block, are shuffled to meet their other pieces.
   Blocks with a longer piece than is kept there are read once more.
2. Each task puts the other lines of its blocks together to records, where it reads them.

The records are then parsed by Spark's own CSV functions.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.operators.lookup import BROADCAST_BYTES, measured_bytes
from starloom.workspace import Workspace

# executors need no copy of this package: what runs there travels by value
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# 128 bits of a file's path, which would go to Python with each line
_FILE = ["file", "file_high"]
_BLOCK = [*_FILE, "start"]
_WHOLE = "text string, header boolean"
_CUT = "file long, file_high long, start long, text string, header boolean, piece int"
# the piece at the end of a block that begins between records; those at the ends of one that does not
_ENDS = (
    "file long, file_high long, start long, odd boolean, header boolean, beginning string, long boolean, "
    "open_end string, open_beginning string, open_long boolean"
)
# characters of a piece that the first reading keeps
_LONGEST = 1 << 20
_BLOCKS_A_CORE = 4
# the end of a record that began in an earlier block, the beginning of one
_END, _BEGINNING = 1, 2


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    # only \n parts lines: a \r within a field stays, one before the \n is dropped later
    path = F.col("_metadata.file_path")
    return (
        spark.read.option("lineSep", "\n")
        .text(paths)
        .select(
            F.xxhash64(path).alias("file"),
            F.xxhash64(F.lit("high"), path).alias("file_high"),
            F.col("_metadata.file_block_start").alias("start"),
            F.col("value").alias("line"),
        )
    )


def _blocks(lines: DataFrame) -> DataFrame:
    """Per block whether it begins within a quoted field."""
    return _opened(lines.mapInArrow(_block_ends, _ENDS))


def _opened(ends: DataFrame) -> DataFrame:
    before = Window.partitionBy(*_FILE).orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    return ends.select(
        *_BLOCK, (F.coalesce(F.count_if("odd").over(before), F.lit(0)) % 2 == 1).alias("open")
    )


class _Piece:
    """Lines that follow each other, while they are not too long."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.long = False
        self._size = 0

    def add(self, lines: pa.Array) -> None:
        if self.long or not len(lines):
            return
        self._size += len(lines) + (pc.sum(pc.binary_length(lines)).as_py() or 0)
        if self._size > _LONGEST:
            self.lines, self.long = [], True
        else:
            self.lines += lines.to_pylist()

    @property
    def text(self) -> str | None:
        return "\n".join(self.lines) if self.lines else None


class _Ends:
    """The pieces at the ends of a block, for both ways in which it may begin.

    Where the quotes up to a line's end are even in number, a record ends there if the block
    begins between records; where they are odd, if it begins within a quoted field.
    """

    def __init__(self, key: tuple):
        self.key = key
        self._odd = 0
        self._headed = key[-1] != 0  # the first record with a text in a file is the header
        self._first = _Piece()  # of a block that begins within a field
        self._closed = False
        self._last = [_Piece(), _Piece()]  # behind the last line with an even, an odd number

    def add(self, lines: pa.Array) -> None:
        after = (np.cumsum(_odd_quotes(lines)) + self._odd) % 2
        self._odd = int(after[-1])
        ends = [np.flatnonzero(after == parity) for parity in (0, 1)]
        if not self._headed and len(ends[0]):
            # a piece that goes on has a quote
            texts = lines.slice(0, int(ends[0][-1]) + 1)
            self._headed = bool(self._last[0].lines or self._last[0].long) or _has_text(texts)
        if not self._closed:
            self._closed = len(ends[1]) > 0
            self._first.add(lines.slice(0, int(ends[1][0]) + 1) if self._closed else lines)
        for parity in (0, 1):
            if len(ends[parity]):
                self._last[parity] = _Piece()
                lines_behind = lines.slice(int(ends[parity][-1]) + 1)
            else:
                lines_behind = lines
            self._last[parity].add(lines_behind)

    def row(self) -> dict:
        even, odd = self._last
        return {
            **dict(zip(_BLOCK, self.key, strict=True)),
            "odd": self._odd == 1,
            "header": not self._headed and even.text is not None,
            "beginning": even.text,
            "long": even.long,
            "open_end": self._first.text,
            # a block in which no record ends is one piece
            "open_beginning": odd.text if self._closed else None,
            "open_long": self._first.long or (self._closed and odd.long),
        }


def _odd_quotes(lines: pa.Array) -> np.ndarray:
    return pc.count_substring(lines, '"').to_numpy(zero_copy_only=False) % 2


def _has_text(lines: pa.Array) -> bool:
    return any(line.as_py().strip("\r") != "" for line in lines)


class _Block:
    """The records of one block, from its lines in their order.

    `add` gives the texts of the whole records, `cut` holds the pieces at its ends.
    """

    def __init__(self, key: tuple, opened: bool):
        self.key = key
        self.cut: list[tuple[str, bool, int]] = []
        self._parity = int(opened)
        self._is_end = opened
        self._kept: list[pa.Array] = []  # lines of the record that goes on
        self._header = key[-1] == 0  # the first record with a text is the header

    def _is_header(self, text: str) -> bool:
        if not self._header or text.strip("\r") == "":
            return False
        self._header = False
        return True

    def add(self, lines: pa.Array) -> pa.Array:
        odd = _odd_quotes(lines)
        if not self._kept and not self._parity and not odd.any():
            return lines
        # the parity behind each line: 0 where a record ends with it
        after = (np.cumsum(odd) + self._parity) % 2
        self._parity = int(after[-1])
        ends = np.flatnonzero(after == 0) + 1 + sum(map(len, self._kept))
        self._kept.append(lines)
        if not len(ends):
            return lines.slice(0, 0)
        lines = pa.concat_arrays(self._kept)
        self._kept = [lines.slice(int(ends[-1]))] if ends[-1] < len(lines) else []
        bounds = pa.array(np.concatenate([[0], ends]), pa.int32())
        texts = pc.binary_join(pa.ListArray.from_arrays(bounds, lines), "\n")
        if self._is_end:
            self.cut.append((texts[0].as_py(), False, _END))
            self._is_end = False
            texts = texts.slice(1)
        return texts

    def headers(self, texts: pa.Array) -> list[bool]:
        found = [False] * len(texts)
        for place in range(len(texts)):
            if not self._header:
                break
            found[place] = self._is_header(texts[place].as_py())
        return found

    def close(self) -> None:
        if self._kept:
            text = "\n".join(line for lines in self._kept for line in lines.to_pylist())
            piece = _END if self._is_end else _BEGINNING
            self.cut.append((text, piece == _BEGINNING and self._is_header(text), piece))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """The key of a block, and lines of it; blocks come one by one."""
    for batch in batches:
        if not batch.num_rows:
            continue
        changes = [np.diff(batch.column(n).to_numpy(zero_copy_only=False)) != 0 for n in _BLOCK]
        bounds = [0, *(np.flatnonzero(np.logical_or.reduce(changes)) + 1).tolist(), batch.num_rows]
        for begin, end in zip(bounds, bounds[1:], strict=False):
            yield tuple(batch.column(n)[begin].as_py() for n in _BLOCK), batch.slice(begin, end - begin)


def _block_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ends: _Ends | None = None

    def found() -> pa.RecordBatch:
        flags, texts = ("odd", "header", "long", "open_long"), ("beginning", "open_end", "open_beginning")
        kinds = dict.fromkeys(_BLOCK, pa.int64()) | dict.fromkeys(flags, pa.bool_())
        kinds |= dict.fromkeys(texts, pa.string())
        row = ends.row()
        return pa.RecordBatch.from_pylist([row], pa.schema([(name, kinds[name]) for name in row]))

    for key, run in _runs(batches):
        if ends is None or ends.key != key:
            if ends is not None:
                yield found()
            ends = _Ends(key)
        ends.add(run.column("line"))
    if ends is not None:
        yield found()


def _by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """A block and lines of it, at its end without lines; blocks come one by one."""
    block: _Block | None = None
    for key, run in _runs(batches):
        opened = run.column("open")[0].as_py()
        if opened is None:
            raise ValueError("files or their blocks changed while they were read")
        if block is None or block.key != key:
            if block is not None:
                yield block, None
            block = _Block(key, opened)
        yield block, run.column("line")
    if block is not None:
        yield block, None


def _check(texts: pa.Array) -> None:
    """Quotes open after a comma or another quote, and close before one.

    In a text with an even number of quotes every other one opens; a doubled quote closes
    and opens again.
    """
    _, offsets, data = texts.buffers()
    if data is None:
        return
    offsets = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8)
    quotes = np.flatnonzero(data[offsets[0] : offsets[-1]] == ord('"')) + offsets[0]
    if not len(quotes):
        return
    record = np.searchsorted(offsets, quotes, side="right") - 1
    first = np.searchsorted(quotes, offsets[:-1])
    opens = (np.arange(len(quotes)) - first[record]) % 2 == 0
    begin, end = offsets[record], offsets[record + 1]
    before = np.where(quotes > begin, data[quotes - 1], ord(","))
    after = np.where(quotes + 1 < end, data[np.minimum(quotes + 1, len(data) - 1)], ord(","))
    at_end = (after == ord("\r")) & (quotes + 2 == end)
    borders = [ord(","), ord('"')]
    sound = np.where(opens, np.isin(before, borders), np.isin(after, borders) | at_end)
    if not sound.all():
        text = texts[int(record[np.argmin(sound)])].as_py()
        raise ValueError(f"malformed CSV record: {text[:200]}")


def _whole_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block, lines in _by_block(batches):
        texts = () if lines is None else block.add(lines)
        block.cut.clear()
        if len(texts):
            _check(texts)
            columns = [texts, pa.array(block.headers(texts))]
            yield pa.RecordBatch.from_arrays(columns, ["text", "header"])


def _cut_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block, lines in _by_block(batches):
        if lines is not None:
            block.headers(block.add(lines))
            continue
        block.close()
        rows = [
            {**dict(zip(_BLOCK, block.key, strict=True)), "text": t, "header": h, "piece": p}
            for t, h, p in block.cut
        ]
        if rows:
            schema = pa.schema(
                [
                    *[(name, pa.int64()) for name in _BLOCK],
                    ("text", pa.string()),
                    ("header", pa.bool_()),
                    ("piece", pa.int32()),
                ]
            )
            yield pa.RecordBatch.from_pylist(rows, schema)


def _without_return(name: str) -> Column:
    text = F.col(name)
    return F.when(F.endswith(text, F.lit("\r")), F.left(text, F.length(text) - 1)).otherwise(text)


def _checked(text: Column) -> Column:
    """The same for a stitched record, which may also end within a field."""
    # without its quoted parts a sound record has quotes at the borders of fields alone;
    # two quoted parts in a row are one field with a doubled quote
    bare = F.regexp_replace(F.regexp_replace(text, '"[^"]*"', '"'), '"+', '"')
    even = F.length(F.regexp_replace(text, '[^"]', "")) % 2 == 0
    message = F.concat(F.lit("malformed CSV record: "), F.left(text, F.lit(200)))
    unsound = bare.rlike('[^,]"|"[^,]') | ~even
    return F.when(unsound, F.raise_error(message)).otherwise(text)


def _placed(lines: DataFrame, blocks: DataFrame, limit: int, how: str = "left") -> DataFrame:
    """The lines in their order, with what is known of their block."""
    if measured_bytes(blocks) <= limit:
        placed = lines.join(F.broadcast(blocks), _BLOCK, how)
    else:
        # lines that are shuffled need their order back
        placed = (
            lines.withColumn("place", F.monotonically_increasing_id())
            .join(blocks, _BLOCK, how)
            .repartition(*_BLOCK)
            .sortWithinPartitions(*_BLOCK, "place")
        )
    return placed.select(*_BLOCK, "line", "open")


def _cut_pieces(lines: DataFrame, ends: DataFrame, workspace: Workspace, limit: int) -> DataFrame:
    """The pieces of records that block borders cut: at most two a block.

    An end stands before the beginning in the same block.
    """

    def piece(text: str, header: Column, kind: int) -> Column:
        return F.struct(F.col(text).alias("text"), header.alias("header"), F.lit(kind).alias("piece"))

    no = F.lit(False)
    opened = F.array(piece("open_end", no, _END), piece("open_beginning", no, _BEGINNING))
    closed = F.array(piece("beginning", F.col("header"), _BEGINNING))
    is_long = F.when(F.col("open"), F.col("open_long")).otherwise(F.col("long"))
    pieces = F.inline(F.when(F.col("open"), opened).otherwise(closed))
    cut = ends.where(~is_long).select(*_BLOCK, pieces).where("text is not null")
    long = workspace.save(ends.where(is_long).select(*_BLOCK, "open"), "long")
    if not long.isEmpty():
        again = _placed(lines, long, limit, "inner").mapInArrow(_cut_records, _CUT)
        cut = cut.unionByName(again)
    return workspace.save(cut, "cut")


def _records(
    spark: SparkSession, paths: list[str], workspace: Workspace, limit: int
) -> DataFrame:
    """text, header: every record of the files as one text."""
    # the files must fall into the same blocks both times, though executors come and go
    tasks = "spark.sql.files.minPartitionNum"
    if spark.conf.get(tasks, None) is None:
        # several blocks a core, so that the last tasks do not leave most cores idle
        spark.conf.set(tasks, str(_BLOCKS_A_CORE * spark.sparkContext.defaultParallelism))
    lines = _lines(spark, paths)
    ends = workspace.save(lines.mapInArrow(_block_ends, _ENDS), "ends")
    blocks = workspace.save(_opened(ends), "blocks")
    whole = _placed(lines, blocks, limit).mapInArrow(_whole_records, _WHOLE)
    cut = _cut_pieces(lines, ends.join(blocks, _BLOCK), workspace, limit)
    order = Window.partitionBy(*_FILE).orderBy("start", "piece")
    stitched = (
        cut.withColumn("record", F.count_if(F.col("piece") == _BEGINNING).over(order))
        .groupBy(*_FILE, "record")
        .agg(
            F.array_sort(F.collect_list(F.struct("start", "piece", "text"))).alias("parts"),
            F.bool_or("header").alias("header"),
        )
        .select(F.array_join(F.col("parts.text"), "\n").alias("text"), "header")
    )
    stitched = stitched.select(_checked(_without_return("text")).alias("text"), "header")
    return whole.unionByName(stitched)


def read_split_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType,
    workspace: Workspace,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Rows of CSV files with a header, where quoted fields may hold line breaks.

    The rows are those of Spark's reader with `multiLine`, which gives each file to one
    task: an empty field is null, a quoted empty field is '', a doubled quote is a quote.
    Records end with \\n or \\r\\n. A row with a wrong number of fields stops the job, and so
    does a quote in or after a field that is not a doubled one, as then quotes do not tell
    where records end; a query that reads no column parses none. An empty file gives no rows.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    records = _records(spark, paths, workspace, limit)
    records = records.where(~F.col("header")).select(_without_return("text").alias("text"))
    records = records.where("text != ''")
    options = {
        "quote": '"',
        "escape": '"',
        "nullValue": "\u0000",
        "multiLine": "true",
        "lineSep": "\n",
        "mode": "FAILFAST",
        "maxCharsPerColumn": "-1",
    }
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parsed = F.from_csv("text", columns, options)
    return records.select(parsed.alias("row")).select("row.*")
