"""Ranked lexical search: a block-max index per shard, searched by MaxScore.

The items are worked on in blocks of bounded size; one pass over the documents serves a block.

1. Documents are cut into shards of about 16 MB. A shard's postings, for the terms that some
   item of the block holds, lie in blocks of 128: each block is compressed by itself and has
   its last document, highest frequency and shortest document beside it.
2. Numbers of documents and terms, overall and per term, are summed over the shards.
3. Every shard answers every item. An item's terms are taken by their bounds, the highest
   first. While the bounds of the terms to come reach the tenth best score, their lists
   are essential and are read whole. Behind that point no new document can enter: the
   candidates alone are looked up, and those that the block's bound cannot lift to the tenth
   best are rejected before the block is decompressed.
4. The shards' best ten are merged, first some shards with each other, then all.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.llm.common import table, text_or_empty, text_session
from starloom.workspace import Workspace

BEST = 10
SHARD_BYTES = 16 << 20
# bytes of item texts that are searched together
ITEMS_BYTES = 8 << 20
POSTINGS = 128
_MERGERS = 64

# letters, digits and all beyond ASCII; A-Z in lower case
_TERM_BYTES = bytes(
    byte + 32
    if chr(byte).isupper() and byte < 0x80
    else byte
    if byte >= 0x80 or chr(byte).isalnum()
    else 0x20
    for byte in range(256)
)


def terms_of(text: str) -> list[bytes]:
    return text.encode("utf-8").translate(_TERM_BYTES).split()


def length_norm(n: np.ndarray | int, documents: int, terms: int):
    return 100 - 90 + (90 * n * documents) // max(terms, 1)


def term_weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def impact(weight: int, times: np.ndarray, norm: np.ndarray) -> np.ndarray:
    return weight * ((1_000_000_000 * times) // (1000 * times + 8 * norm))


def _narrow(numbers: np.ndarray) -> tuple[bytes, int]:
    """The numbers in as many bytes each as the largest needs, and that width."""
    most = int(numbers.max()) if len(numbers) else 0
    width = next(w for w in (1, 2, 4, 8) if most < 1 << 8 * w)
    return numbers.astype(f"<u{width}").tobytes(), width


class PostingsWriter:
    """The postings of a shard: `heads` names the blocks of all terms, `body` holds them."""

    def __init__(self, term: np.ndarray, document: np.ndarray, times: np.ndarray, sizes: np.ndarray):
        start = np.flatnonzero(np.diff(term, prepend=-1))
        self.terms = term[start]
        self.holding = np.diff(start, append=len(term))
        heads, body, at = [], [], 0
        for first, holding in zip(start.tolist(), self.holding.tolist(), strict=True):
            for begin in range(first, first + holding, POSTINGS):
                end = min(begin + POSTINGS, first + holding)
                own = document[begin:end]
                gaps, wide = _narrow(np.diff(own, prepend=0))
                counts, broad = _narrow(times[begin:end])
                heads.append(
                    (at, end - begin, wide, broad, own[-1], times[begin:end].max(), sizes[own].min())
                )
                body += [gaps, counts]
                at += len(gaps) + len(counts)
        self.heads = np.array(heads, dtype="<i8").reshape(-1, 7)
        self.body = b"".join(body)


class Postings:
    """A term's blocks in one shard, decompressed when first asked for."""

    def __init__(self, heads: np.ndarray, body: bytes, weight: int, norm: np.ndarray, norms):
        self.at, self.n, self.wide, self.broad, self.last, times, shortest = heads.T
        self.body, self.weight, self.norm = body, weight, norm
        self.bounds = impact(weight, times, norms(shortest))
        self.bound = int(self.bounds.max())
        self.blocks: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.whole: tuple[np.ndarray, np.ndarray] | None = None

    def block(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents of a block and what the term adds to their scores."""
        if k not in self.blocks:
            at, n, wide, broad = (int(x[k]) for x in (self.at, self.n, self.wide, self.broad))
            gaps = np.frombuffer(self.body, f"<u{wide}", n, at)
            times = np.frombuffer(self.body, f"<u{broad}", n, at + n * wide).astype(np.int64)
            documents = np.cumsum(gaps, dtype=np.int64)
            self.blocks[k] = documents, impact(self.weight, times, self.norm[documents])
        return self.blocks[k]

    def all(self) -> tuple[np.ndarray, np.ndarray]:
        if self.whole is None:
            parts = [self.block(k) for k in range(len(self.n))]
            self.whole = tuple(np.concatenate(side) for side in zip(*parts, strict=True))
            self.blocks = {}
            self.last, self.bounds = self.last[-1:], np.array([self.bound])
            self.blocks[0] = self.whole
        return self.whole


def best_of_shard(lists: list[Postings], n: int, best: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents that may be among the best, ties included, and their scores."""
    lists = sorted(lists, key=lambda postings: -postings.bound)
    # what the lists from each one on can add
    rest = np.cumsum([0, *[postings.bound for postings in reversed(lists)]])[::-1]
    scores = np.zeros(n, dtype=np.int64)

    def tenth(of: np.ndarray) -> int:
        return int(np.partition(of, -best)[-best]) if len(of) >= best else 0

    least, k = 1, 0
    while k < len(lists) and rest[k] >= least:
        documents, added = lists[k].all()
        scores[documents] += added
        k += 1
        # the tenth best cannot exceed the best
        if scores.max() > rest[k]:
            least = max(least, tenth(scores))
    found = np.flatnonzero(scores)
    found = found[scores[found] + rest[k] >= least]
    for postings, after in zip(lists[k:], rest[k + 1 :], strict=True):
        place = np.searchsorted(postings.last, found)
        inside = place < len(postings.last)
        bound = np.where(inside, postings.bounds[np.minimum(place, len(postings.last) - 1)], 0)
        alive = scores[found] + bound + after >= least
        found, place, inside = found[alive], place[alive], inside[alive]
        for block in np.unique(place[inside]).tolist():
            documents, added = postings.block(block)
            own = found[place == block]
            at = np.minimum(np.searchsorted(documents, own), len(documents) - 1)
            same = documents[at] == own
            scores[own[same]] += added[at[same]]
        least = max(least, tenth(scores[found]))
    found = found[scores[found] >= least]
    return found, scores[found]


def _indexed(wanted: dict[bytes, int], shard_bytes: int):
    def shard(ids: list, texts: list[str], kind) -> pa.RecordBatch:
        term, document, sizes = [], [], []
        for place, text in enumerate(texts):
            words = terms_of(text)
            sizes.append(len(words))
            own = [number for number in map(wanted.get, words) if number is not None]
            term.append(np.array(own, dtype=np.int64))
            document.append(np.full(len(own), place))
        sizes = np.array(sizes, dtype=np.int64)
        keys = np.concatenate(term) * len(texts) + np.concatenate(document)
        keys, times = np.unique(keys, return_counts=True)
        term, document = np.divmod(keys, len(texts))
        postings = PostingsWriter(term, document, times, sizes)
        values = {
            "ids": pa.array([ids], pa.list_(kind)),
            "sizes": pa.array([sizes.astype("<i8").tobytes()], pa.binary()),
            "documents": pa.array([int((sizes > 0).sum())], pa.int64()),
            "terms": pa.array([int(sizes.sum())], pa.int64()),
            "term": pa.array([postings.terms], pa.list_(pa.int64())),
            "holding": pa.array([postings.holding], pa.list_(pa.int64())),
            "heads": pa.array([postings.heads.tobytes()], pa.binary()),
            "body": pa.array([postings.body], pa.binary()),
        }
        return pa.RecordBatch.from_arrays(list(values.values()), list(values))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, size, kind = [], [], 0, pa.int64()
        for batch in batches:
            kind = batch.column(0).type
            for row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids.append(row[0])
                texts.append(row[1])
                size += len(row[1])
                if size >= shard_bytes:
                    yield shard(ids, texts, kind)
                    ids, texts, size = [], [], 0
        if ids:
            yield shard(ids, texts, kind)

    return run


def _searched(items: list[list[int]], weights: dict[int, int], documents: int, terms: int, best: int):
    def norms(sizes: np.ndarray) -> np.ndarray:
        return length_norm(sizes, documents, terms)

    def answers(row: dict) -> Iterator[tuple[int, object, int]]:
        norm = norms(np.frombuffer(row["sizes"], "<i8"))
        heads = np.frombuffer(row["heads"], "<i8").reshape(-1, 7)
        blocks = -(-np.array(row["holding"], dtype=np.int64) // POSTINGS)
        ends = np.cumsum(blocks)
        lists = {
            term: Postings(heads[end - n : end], row["body"], weights[term], norm, norms)
            for term, n, end in zip(row["term"], blocks.tolist(), ends.tolist(), strict=True)
        }
        ids = row["ids"]
        for item, own in enumerate(items):
            here = [lists[term] for term in own if term in lists and lists[term].bound > 0]
            if here:
                found, scores = best_of_shard(here, len(ids), best)
                rows = sorted(
                    zip((-scores).tolist(), [ids[place] for place in found], strict=True),
                    key=lambda pair: (pair[0], pair[1] is None, pair[1]),
                )
                yield from ((item, doc_id, -score) for score, doc_id in rows[:best])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind = batch.schema.field("ids").type.value_type
            for row in batch.to_pylist():
                found = list(answers(row))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([item for item, _, _ in found], pa.int64()),
                        pa.array([doc_id for _, doc_id, _ in found], kind),
                        pa.array([score for _, _, score in found], pa.int64()),
                    ],
                    ["item", "doc_id", "score"],
                )

    return run


def _merged(found: DataFrame, best: int) -> DataFrame:
    """The best rows of each item: some tasks' with each other first, then all."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    for by in (["item", F.spark_partition_id() % _MERGERS], ["item"]):
        rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
        found = found.withColumn("rank", rank).filter(F.col("rank") <= best)
    return found


def _blocks(items: DataFrame, most: int) -> Iterator[list[tuple[object, str]]]:
    """The items in blocks of about `most` bytes; the driver holds one block at a time."""
    block, size = [], 0
    for item_id, text in items.toLocalIterator():
        block.append((item_id, text))
        size += len(text)
        if size >= most:
            yield block
            block, size = [], 0
    if block:
        yield block


def ranked_search(
    items: DataFrame,
    docs: DataFrame,
    best: int = BEST,
    item_col: str = "item_id",
    id_col: str = "doc_id",
    text_col: str = "text",
    shard_bytes: int = SHARD_BYTES,
    items_bytes: int = ITEMS_BYTES,
    workspace: Workspace | None = None,
) -> DataFrame:
    """The best documents for each item: item_id, rank, doc_id, score.

    Terms are runs of letters, digits and characters beyond ASCII, A-Z in lower case; an
    item's terms count once each. Scores are whole numbers; only those above zero are ranked,
    equal ones by the lower id, a null id last. Equal rows of the documents are documents of
    their own, and so are equal rows of the items. A null text has no terms; an item without
    terms, or whose terms no document holds, has no row. A text of any length is read whole,
    at the end of its shard. Empty tables give an empty result; other columns are not read.
    """
    spark = text_session(docs.sparkSession)
    workspace = workspace or Workspace(spark)
    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    asked = items.select(F.col(item_col).alias("item_id"), text_or_empty(text_col).alias("text"))
    item_kind = asked.schema["item_id"].dataType.simpleString()
    schema = f"item_id {item_kind}, rank int, doc_id {kind}, score long"
    path = workspace.fresh_path("ranked")
    spark.createDataFrame([], schema).write.parquet(path)
    for block in _blocks(asked, items_bytes):
        wanted: dict[bytes, int] = {}
        own = [
            [wanted.setdefault(term, len(wanted)) for term in sorted(set(terms_of(text)))]
            for _, text in block
        ]
        index = workspace.save(
            rows.mapInArrow(
                _indexed(wanted, shard_bytes),
                f"ids array<{kind}>, sizes binary, documents long, terms long, "
                "term array<long>, holding array<long>, heads binary, body binary",
            ),
            "index",
        )
        documents, terms = index.agg(F.sum("documents"), F.sum("terms")).first()
        # at most the terms of one block of items
        holding = (
            index.select(F.explode(F.arrays_zip("term", "holding")).alias("pair"))
            .groupBy("pair.term")
            .agg(F.sum("pair.holding").alias("holding"))
            .collect()
        )
        weights = {row["term"]: term_weight(documents, row["holding"]) for row in holding}
        found = index.mapInArrow(
            _searched(own, weights, documents or 0, terms or 0, best),
            f"item long, doc_id {kind}, score long",
        )
        names = spark.createDataFrame(
            [(place, item_id) for place, (item_id, _) in enumerate(block)],
            f"item long, item_id {item_kind}",
        )
        _merged(found, best).join(F.broadcast(names), "item").select(
            "item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"
        ).write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)


def op12_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranked_search(table(spark, folder, "benchmark"), table(spark, folder, "documents"))


_TERMS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

ORACLE = f"""
WITH folded AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                  'abcdefghijklmnopqrstuvwxyz'), '{_TERMS}') AS terms
    FROM documents
),
totals AS (
    SELECT count(*) FILTER (len(terms) > 0) AS n_docs, sum(len(terms))::BIGINT AS n_terms
    FROM folded
),
wanted AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                  'abcdefghijklmnopqrstuvwxyz'), '{_TERMS}')) AS term
    FROM benchmark
),
occurrences AS (SELECT doc_id, len(terms) AS n, unnest(terms) AS term FROM folded),
postings AS (
    SELECT doc_id, n, term, count(*) AS tf FROM occurrences
    WHERE term IN (SELECT term FROM wanted) GROUP BY ALL
),
weights AS (
    SELECT term, floor(1000 * ln((2 * max(n_docs) + 2) / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
    FROM postings, totals GROUP BY term
),
scores AS (
    SELECT item_id, doc_id,
           sum(w * ((1000000000 * tf)
               // (1000 * tf + 8 * (100 - 90 + ((90 * n * n_docs) // n_terms)))))::BIGINT AS score
    FROM wanted JOIN postings USING (term) JOIN weights USING (term), totals
    GROUP BY item_id, doc_id
),
ranked AS (
    SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER
           AS rank, doc_id, score
    FROM scores WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
