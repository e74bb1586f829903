"""Cross-tokenizer alignment: each distinct text once, its measures joined to its documents.

1. Texts are shuffled whole and made distinct; how often each occurs stays with it.
2. Every distinct text is encoded by both tokenizers. The byte offsets where a token of each
   ends cut the text into groups, and the two tokens that end there are linked. The ids of
   the links are stored, sorted and compressed.
3. Links are counted by pair of ids, each as often as its text occurs. One of two tokens that
   end together is a suffix of the other, so the pairs are at most as many as the bytes of
   both vocabularies, whatever the corpus: their counts are a table that every task can hold.
4. The measures of each distinct text meet the documents by its SHA-256.

A worker remembers the alignment of words it has met. A text is cut into words where a
single blank or line break stands between other characters than white space: no token of
either vocabulary has a blank behind another character or a line break beside one, so the
tokens of a text are those of its words.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.llm.common import table, text_session
from starloom.llm.packed import pack, unpack
from starloom.llm.tokens import BYTE_RANKS, load_ranks, per_worker, vocabulary_path
from starloom.workspace import Workspace

PIECE_MODEL = "piece_bpe_32k.model"
# words a worker remembers, about 350 bytes each, and the longest of them
MOST_WORDS = 300_000
LONGEST_WORD = 64
# links that are counted together
_LINKS = 4 << 20
_PIECE_BLANK = "▁"


class Aligner:
    """The first vocabulary takes a blank before the text; the second adds it by itself."""

    def __init__(self, ranks: str, model: str):
        import sentencepiece

        self.first = load_ranks(ranks)
        self.second = sentencepiece.SentencePieceProcessor(model_file=vocabulary_path(model))
        self.first_bytes = [self.first.decode_single_token_bytes(k) for k in range(self.first.n_vocab)]
        self.second_bytes = [self._piece_bytes(k) for k in range(len(self.second))]
        self.base = len(self.second)
        self.kind = np.dtype("<u4" if len(self.first_bytes) * self.base < 1 << 32 else "<u8")
        self.words: dict[str, tuple | None] = {}

    @staticmethod
    def loaded(ranks: str, model: str) -> Aligner:
        return per_worker(f"aligner {ranks} {model}", lambda: Aligner(ranks, model))

    def _piece_bytes(self, number: int) -> bytes:
        piece = self.second.id_to_piece(number)
        if self.second.is_byte(number):
            return bytes([int(piece[3:5], 16)])
        return piece.replace(_PIECE_BLANK, " ").encode("utf-8")

    def _align(self, text: bytes, first: list[int], second: list[int]) -> tuple | None:
        """Numbers of tokens and groups, links, and the groups as text; None for other bytes."""
        own = [self.first_bytes[k] for k in first]
        other = [self.second_bytes[k] for k in second]
        if b"".join(own) != text or b"".join(other) != text:
            return None
        links, groups = [], []
        i = j = begin = start = 0
        end, stop = len(own[0]), len(other[0])
        while True:
            if end < stop:
                i += 1
                end += len(own[i])
            elif stop < end:
                j += 1
                stop += len(other[j])
            else:
                links.append(first[i] * self.base + second[j])
                left = ",".join(map(str, first[begin : i + 1]))
                groups.append(f"{left}|{','.join(map(str, second[start : j + 1]))};")
                i, j = i + 1, j + 1
                if end == len(text):
                    break
                begin, start = i, j
                end += len(own[i])
                stop += len(other[j])
        packed = np.array(links, dtype=self.kind).tobytes()
        return len(first), len(second), len(links), packed, "".join(groups).encode("ascii")

    def _learn(self, words: list[str]) -> None:
        after_break = [word[0] == "\n" for word in words]
        found = self.second.encode(words, num_threads=1)
        for word, cut, second in zip(words, after_break, found, strict=True):
            # the blank that the model adds is no part of a word behind a line break
            text = word if cut else " " + word
            second = second[1:] if cut else second
            first = self.first.encode_ordinary(text)
            self.words[word] = self._align(text.encode("utf-8"), first, second)

    def align(self, text: str) -> tuple[list, list] | None:
        """The words' alignments in order, or None if a tokenizer changes the text."""
        words = _words(text)
        if words is None:
            # other white space: only blanks between two other characters cut
            cut = _BLANK.split(" " + text)
            long = [self._whole(piece if k == 0 else " " + piece) for k, piece in enumerate(cut)]
            return None if None in long else long
        new = [word for word in set(words).difference(self.words) if len(word) <= LONGEST_WORD]
        if new:
            if len(self.words) + len(new) > MOST_WORDS:
                self.words = {}
                new = [word for word in set(words) if len(word) <= LONGEST_WORD]
            self._learn(new)
        known = self.words
        found = [
            known[word] if word in known else self._whole(word if word[0] == "\n" else " " + word)
            for word in words
        ]
        return None if None in found else found

    def _whole(self, text: str) -> tuple | None:
        """The alignment of a text that starts with a blank or a line break."""
        behind = text[0] == " "
        second = self.second.encode(text[1:] if behind else text)
        first = self.first.encode_ordinary(text)
        return self._align(text.encode("utf-8"), first, second if behind else second[1:])


_BLANK = re.compile(r"(?<=\S) (?=\S)")


def _words(text: str) -> list[str] | None:
    """Words between single blanks, or with the single line break before them."""
    words = (" " + text).replace("\n", " \n").split(" ")[1:]
    if "" in words or len(text.split()) != len(words):
        return None
    return words


def _aligned(ranks: str, model: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner.loaded(ranks, model)
        for batch in batches:
            texts, copies = (batch.column(k).to_pylist() for k in range(2))
            rows = [row(aligner, text) for text in texts]
            columns = list(zip(*rows, strict=True)) or [()] * len(_KINDS)
            arrays = [pa.array(c, k) for c, k in zip(columns, _KINDS, strict=True)]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(copies, pa.int64())], _NAMES)

    def row(aligner: Aligner, text: str) -> tuple:
        digest = hashlib.sha256(text.encode("utf-8")).digest()
        found = aligner.align(text)
        if found is None:
            return digest, 0, 0, 0, None, ""
        n_a, n_b, n_groups, links, groups = zip(*found, strict=True)
        numbers = np.sort(np.frombuffer(b"".join(links), aligner.kind))
        signature = hashlib.sha256(b"".join(groups)[:-1]).hexdigest()
        return digest, sum(n_a), sum(n_b), sum(n_groups), pack([numbers], [True]), signature

    return run


_NAMES = ["digest", "n_a", "n_b", "n_groups", "links", "groups_sha256", "copies"]
_KINDS = [pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string()]
_MEASURES = (
    "digest binary, n_a long, n_b long, n_groups long, links binary, groups_sha256 string, copies long"
)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Weighted counts of the pairs of a task; never more rows than there are pairs."""
    links = np.zeros(0, dtype=np.uint64)
    times = np.zeros(0, dtype=np.int64)
    waiting: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0

    def summed() -> tuple[np.ndarray, np.ndarray]:
        every = np.concatenate([links, *(numbers for numbers, _ in waiting)])
        weight = np.concatenate([times, *(weights for _, weights in waiting)])
        order = np.argsort(every, kind="stable")
        every, weight = every[order], weight[order]
        start = np.flatnonzero(np.diff(every.astype(np.int64), prepend=-1))
        return every[start], np.add.reduceat(weight, start) if len(start) else weight

    for batch in batches:
        for payload, copies in zip(*(batch.column(k).to_pylist() for k in range(2)), strict=True):
            numbers, count = np.unique(unpack(payload)[0], return_counts=True)
            waiting.append((numbers, count * copies))
            size += len(numbers)
            if size > _LINKS:
                links, times = summed()
                waiting, size = [], 0
    links, times = summed()
    yield pa.RecordBatch.from_arrays(
        [pa.array(links.astype(np.int64), pa.int64()), pa.array(times, pa.int64())], ["pair", "n"]
    )


def _weighed(pairs: np.ndarray, counts: np.ndarray, best: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            payloads = batch.column(1).to_pylist()
            sums = []
            for payload in payloads:
                numbers = unpack(payload)[0].astype(np.int64) if payload else pairs[:0]
                place = np.searchsorted(pairs, numbers)
                sums.append((int(best[place].sum()), int(counts[place].sum())))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([n for n, _ in sums], pa.int64()),
                    pa.array([n for _, n in sums], pa.int64()),
                ],
                ["digest", "n_best", "count_sum"],
            )

    return run


def pair_counts(measures: DataFrame, base: int) -> DataFrame:
    """How many links of all documents hold each pair, and whether none of its B id has more."""
    counts = (
        measures.filter("links is not null")
        .select("links", "copies")
        .mapInArrow(_counted, "pair long, n long")
        .groupBy("pair")
        .agg(F.sum("n").alias("n"))
    )
    b = F.col("pair") % base
    return counts.withColumn("best", F.col("n") == F.max("n").over(Window.partitionBy(b)))


def alignment_measures(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    ranks: str = BYTE_RANKS,
    model: str = PIECE_MODEL,
    workspace: Workspace | None = None,
) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A is a byte-level vocabulary given by its ranks, which reads a blank and the text; B a
    sentencepiece model with byte fallback that adds the blank. Strings of special tokens are
    plain text. A link is two tokens, of A and B, that end at the same byte; its count is the
    number of links of all documents with the same ids. `n_best` counts the links whose count
    is the highest of their B id, ties included, `count_sum` adds the counts up.

    A null or empty text, and one that either vocabulary does not give back byte by byte, has
    no tokens: zeros and an empty string. Null and repeated ids pass through, one row for each
    document; equal texts share their measures and count as often as they occur. A word of any
    length is aligned whole. An empty table gives an empty result; other columns are not read.
    """
    import sentencepiece

    spark = text_session(docs.sparkSession)
    workspace = workspace or Workspace(spark)
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    some = F.coalesce(F.col("text") != "", F.lit(False))
    distinct = rows.filter(some).groupBy("text").agg(F.count("*").alias("copies"))
    measures = workspace.save(distinct.mapInArrow(_aligned(ranks, model), _MEASURES), "aligned")

    base = len(sentencepiece.SentencePieceProcessor(model_file=vocabulary_path(model)))
    # not more pairs than bytes in both vocabularies
    found = pair_counts(measures, base).toPandas().sort_values("pair")
    pairs, counts = found["pair"].to_numpy(np.int64), found["n"].to_numpy(np.int64)
    weighed = workspace.save(
        measures.select("digest", "links").mapInArrow(
            _weighed(pairs, counts, found["best"].to_numpy(bool)),
            "digest binary, n_best long, count_sum long",
        ),
        "weighed",
    )
    numbers = measures.select("digest", "n_a", "n_b", "n_groups", "groups_sha256").join(
        weighed, "digest"
    )
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    digest = F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest")
    # a text that many documents share is a hot key, which adaptive execution splits
    met = rows.filter(some).select("doc_id", digest).join(numbers, "digest")
    none = rows.filter(~some).select(
        "doc_id", *[F.lit(0).cast("long").alias(c) for c in columns[1:-1]], F.lit("").alias(columns[-1])
    )
    return met.withColumn("n_links", F.col("n_groups")).select(columns).unionByName(none)


def op13_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment_measures(table(spark, folder, "documents"))
