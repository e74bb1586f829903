"""Language model scores: bigrams of the whole corpus in Elias-Fano tries, one per shard.

No executor has to hold the model. Words are told apart by 64-bit hashes, shards are ranges
of them, and the number of shards follows the number of words.

1. Texts are read once, in batches of about 16 MB. A batch is written as its distinct
   hashes in order and its tokens as places among them.
2. Each batch asks each shard for the words and bigrams it holds, every one once, with how
   often the batch learned it. A word with more than a shard's share of all words is a hot
   context: its followers are dealt over several shards by their own hashes, and each of
   these shards gets its counts too.
3. A shard sums the counts of all batches, builds its trie (`ngram_trie`), and answers each
   batch: the counts and numbers of followers of its words, the codes of its bigrams.
4. The answers return to their batch, which scores its documents.

The model is interpolated absolute discounting. With the count c(v, w) of a bigram, t(v)
different words after v and unigrams p(w) = (c(w) + 1) / (N + V + 1),

    p(w | v) = max(c(v, w) - D, 0) / c(v)  +  D t(v) / c(v) * p(w)

where the first part is the trie's quantised probability. A text starts and ends with one
boundary, which is learned as a word; words that were not learned share one place of V + 1.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import table, text_or_empty, text_session
from starloom.llm.ngram_trie import NgramTrie, probabilities, quantised, trie_bytes
from starloom.llm.packed import pack, unpack
from starloom.workspace import Workspace

DISCOUNT = 0.75
# bytes of text in a batch, and learned tokens of a shard
BATCH_BYTES = 16 << 20
SHARD_TOKENS = 1_000_000
_LOWER = bytes(byte + 32 if 65 <= byte <= 90 else byte for byte in range(256))
# no word holds a blank
_BOUNDARY = b" "


def _hashed(words: list[bytes]) -> np.ndarray:
    from xxhash import xxh64_intdigest

    return np.array([xxh64_intdigest(word) for word in words], dtype=np.uint64)


def _batch_row(ids: list, texts: list[str], learned: list[bool], name: int, kind) -> pa.RecordBatch:
    places: dict[bytes, int] = {_BOUNDARY: 0}
    tokens, sizes = [np.zeros(1, dtype=np.int32)], []
    for text in texts:
        words = text.encode("utf-8").translate(_LOWER).split()
        for word in set(words).difference(places):
            places[word] = len(places)
        found = np.fromiter(map(places.__getitem__, words), np.int32, len(words))
        tokens += [found, tokens[0]]
        sizes.append(len(words) + 1)
    hashes, rank = np.unique(_hashed(list(places)), return_inverse=True)
    # 16 more bits of each word tell which slice of a hot context it is in
    slices = hashes & np.uint64(0xFFFF)
    body = pack([rank[np.concatenate(tokens)], sizes, learned, slices], [False, False, False, False])
    taught = int(np.dot(sizes, learned))
    return pa.RecordBatch.from_arrays(
        [
            pa.array([name], pa.int64()),
            pa.array([taught], pa.int64()),
            pa.array([ids], pa.list_(kind)),
            pa.array([pack([hashes], [True])], pa.binary()),
            pa.array([body], pa.binary()),
        ],
        ["batch", "taught", "ids", "hashes", "body"],
    )


def _read_batches(batch_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        first = TaskContext.get().partitionId() << 32
        ids, texts, learned, size, done, kind = [], [], [], 0, 0, pa.int64()
        for batch in batches:
            kind = batch.column(0).type
            for row in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                ids.append(row[0])
                texts.append(row[1])
                learned.append(row[2])
                size += len(row[1])
                if size >= batch_bytes:
                    yield _batch_row(ids, texts, learned, first + done, kind)
                    ids, texts, learned, size, done = [], [], [], 0, done + 1
        if ids:
            yield _batch_row(ids, texts, learned, first + done, kind)

    return run


def _bigrams(body: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Tokens, sizes of the documents, whether each bigram is learned, slices of the words."""
    tokens, sizes, learned, slices = unpack(body)
    # a batch has its tokens in memory several times over: as narrow as they go
    tokens, sizes = tokens.astype(np.int32), sizes.astype(np.int64)
    return tokens, sizes, np.repeat(learned.astype(np.int8), sizes), slices.astype(np.int64)


def _pairs(tokens: np.ndarray, n: int) -> np.ndarray:
    """Each bigram of the batch as one number."""
    pairs = tokens[:-1].astype(np.int64)
    pairs *= n
    pairs += tokens[1:]
    return pairs


def _begins(ordered: np.ndarray) -> np.ndarray:
    """Where another number begins, among numbers in order."""
    begins = np.ones(len(ordered), dtype=bool)
    np.not_equal(ordered[1:], ordered[:-1], out=begins[1:])
    return begins


def _home(hashes: np.ndarray, shards: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def _shard_of(
    context: np.ndarray,
    follower: np.ndarray,
    home: np.ndarray,
    spread: np.ndarray,
    slices: np.ndarray,
    shards: int,
) -> np.ndarray:
    """Where a bigram lives: with its context, or with a slice of a hot one's followers."""
    own = spread[context]
    slice_ = 1 + (slices[follower] * own >> 16)
    return np.where(own > 1, (home[context] + slice_) % shards, home[context])


def _entries(home: np.ndarray, spread: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Shard and word of every answer a batch gets: at home, and in each slice of a hot word."""
    word = np.arange(len(home))
    shard = [home]
    for hot in np.flatnonzero(spread > 1):
        places = (home[hot] + 1 + np.arange(spread[hot])) % shards
        # a slice may fall on the word's own home
        shard.append(places[places != home[hot]])
        word = np.concatenate([word, np.full(len(shard[-1]), hot)])
    shard = np.concatenate(shard)
    order = np.lexsort((word, shard))
    return shard[order], word[order]


def _local_counts(batches: Iterator[pa.RecordBatch], shards: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for hashes, body in zip(*(batch.column(k).to_pylist() for k in range(2)), strict=True):
            tokens, _, learned, _ = _bigrams(body)
            (words,) = unpack(hashes)
            counts = np.bincount(tokens[:-1], weights=learned, minlength=len(words))
            # a word with a share of all tokens has it in some batch
            often = np.flatnonzero((counts > 0) & (counts * shards >= learned.sum()))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(words[often].view(np.int64), pa.int64()),
                    pa.array(counts[often].astype(np.int64), pa.int64()),
                ],
                ["word", "n"],
            )


def _hot_words(batches: DataFrame, taught: int, shards: int) -> dict[int, int]:
    """Hashes of the words that fill more than a shard, at most one a shard, and their slices."""
    counts = batches.select("hashes", "body").mapInArrow(
        lambda rows: _local_counts(rows, shards), "word long, n long"
    )
    totals = counts.groupBy("word").agg(F.sum("n").alias("n"))
    hot = totals.filter(F.col("n") * shards >= taught).collect()
    # the followers of a hot word take as many shards as its tokens would fill
    return {
        row["word"] % (1 << 64): min(shards, 1 + -(-row["n"] * shards // taught)) for row in hot
    }


def _spread(hashes: np.ndarray, hot: dict[int, int]) -> np.ndarray:
    spread = np.ones(len(hashes), dtype=np.int64)
    if hot:
        words = np.array(sorted(hot), dtype=np.uint64)
        at = np.minimum(np.searchsorted(words, hashes), len(words) - 1)
        own = np.array([hot[int(word)] for word in words], dtype=np.int64)
        spread = np.where(words[at] == hashes, own[at], 1)
    return spread


def _questions(shards: int, hot: dict[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = (batch.column(k).to_pylist() for k in range(3))
            for name, hashes, body in zip(*columns, strict=True):
                yield from ask(name, unpack(hashes)[0], body)

    def ask(name: int, hashes: np.ndarray, body: bytes) -> Iterator[pa.RecordBatch]:
        tokens, _, learned, slices = _bigrams(body)
        n = len(hashes)
        counts = np.bincount(tokens[:-1], weights=learned, minlength=n).astype(np.int64)
        keys = _pairs(tokens, n)
        keys *= 2
        keys += learned
        del tokens, learned
        keys.sort()
        taught = (keys & 1).astype(np.int8)
        keys >>= 1
        start = np.flatnonzero(_begins(keys))
        times = np.add.reduceat(taught, start, dtype=np.int64)
        context, follower = np.divmod(keys[start], n)
        del keys, taught
        home, spread = _home(hashes, shards), _spread(hashes, hot)
        shard = _shard_of(context, follower, home, spread, slices, shards)
        order = np.argsort(shard, kind="stable")
        context, follower, times, shard = (x[order] for x in (context, follower, times, shard))
        entry_shard, entry = _entries(home, spread, shards)
        asked = np.unique(entry_shard)
        edges = np.searchsorted(shard, [asked, asked + 1])
        entry_edges = np.searchsorted(entry_shard, [asked, asked + 1])
        payloads = []
        for (a, b), (c, d) in zip(edges.T, entry_edges.T, strict=True):
            own = entry[c:d]
            words, place = np.unique(np.concatenate([own, follower[a:b]]), return_inverse=True)
            payloads.append(
                pack(
                    [
                        hashes[words],
                        place[: d - c],
                        counts[own],
                        # bigrams of each entry, as both are in the order of the words
                        np.diff(np.searchsorted(context[a:b], own), append=b - a),
                        place[d - c :],
                        times[a:b],
                    ],
                    [True, True],
                )
            )
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(asked), name), pa.int64()),
                pa.array(asked, pa.int64()),
                pa.array(payloads, pa.binary()),
            ],
            ["batch", "shard", "question"],
        )

    return run


def _answers(shards: int, hot: dict[int, int], discount: float):
    def run(rows: pa.Table) -> pa.Table:
        shard = rows.column("shard")[0].as_py()
        names = rows.column("batch").to_pylist()
        asked = [unpack(question) for question in rows.column("question").to_pylist()]
        words = np.unique(np.concatenate([question[0] for question in asked]))
        place = [np.searchsorted(words, question[0]) for question in asked]
        total = np.zeros(len(words), dtype=np.int64)
        entry, keys, times = [], [], []
        for at, (_, own, counts, sizes, follower, learned) in zip(place, asked, strict=True):
            own = at[own.astype(np.int64)]
            entry.append(own)
            np.add.at(total, own, counts.astype(np.int64))
            context = np.repeat(own, sizes.astype(np.int64))
            keys.append(context * len(words) + at[follower.astype(np.int64)])
            times.append(learned.astype(np.int64))
        known = np.concatenate(keys)
        count = np.concatenate(times)
        order = np.argsort(known[count > 0], kind="stable")
        known, count = known[count > 0][order], count[count > 0][order]
        start = np.flatnonzero(np.diff(known, prepend=-1))
        known = known[start]
        count = np.add.reduceat(count, start) if len(start) else count
        context, follower = np.divmod(known, len(words))
        share = np.maximum(count - discount, 0) / np.maximum(total[context], 1)
        trie = NgramTrie(trie_bytes(words, context, follower, quantised(share)))

        home = _home(words, shards) == shard
        spread = np.where(home, _spread(words, hot), 0)
        payloads = []
        for own, wanted, (hashes, *_) in zip(entry, keys, asked, strict=True):
            here = trie.place(hashes)
            where = np.zeros(len(words), dtype=np.int64)
            where[here] = here
            context, follower = np.divmod(wanted, len(words))
            codes = trie.code(where[context], where[follower])
            payloads.append(pack([total[own], trie.types(own), spread[own], codes]))
        learned = home & (total > 0)
        return pa.table(
            {
                "batch": pa.array([*names, None], pa.int64()),
                "shard": pa.array([shard] * (len(names) + 1), pa.int64()),
                "answer": pa.array([*payloads, None], pa.binary()),
                "words": pa.array([None] * len(names) + [int(learned.sum())], pa.int64()),
            }
        )

    return run


def _scored(shards: int, taught: int, distinct: int, discount: float, kind):
    share = probabilities()

    def run(rows: pa.Table) -> pa.Table:
        bodies = rows.column("body").to_pylist()
        (own,) = [k for k, body in enumerate(bodies) if body is not None]
        tokens, sizes, learned, slices = _bigrams(bodies[own])
        n = len(slices)
        answers = zip(rows.column("shard").to_pylist(), rows.column("answer").to_pylist(), strict=True)
        found = [(shard, unpack(answer)) for shard, answer in answers if answer is not None]
        found.sort(key=lambda pair: pair[0])
        totals, types, spreads, codes = (
            np.concatenate([answer[k] for _, answer in found]).astype(np.int64) for k in range(4)
        )
        where = np.repeat([shard for shard, _ in found], [len(answer[0]) for _, answer in found])
        # the entries at home are the words in order
        at_home = spreads > 0
        home, spread, count = where[at_home], spreads[at_home], totals[at_home]
        _, entry = _entries(home, spread, shards)
        kinds = np.bincount(entry, weights=types, minlength=n)

        starts = np.cumsum(sizes) - sizes
        predicted = tokens[1:]
        held_out = learned[starts] == 0
        pairs = _pairs(tokens, n)
        del learned, bodies, found, answers
        order = np.argsort(pairs)
        pairs = pairs[order]
        begins = _begins(pairs)
        context, follower = np.divmod(pairs[begins], n)
        del pairs
        shard = _shard_of(context, follower, home, spread, slices, shards)
        code = np.zeros(len(context), dtype=np.int64)
        code[np.argsort(shard, kind="stable")] = codes
        unigram = (count + 1) / (taught + distinct + 1)
        before = count[context]
        rest = np.where(before > 0, discount * kinds[context] / np.maximum(before, 1), 1.0)
        log = np.log10(share[code] + rest * unigram[follower])
        place = np.cumsum(begins, dtype=np.int32)
        place -= 1
        scores = np.empty(len(order))
        scores[order] = log[place]
        del order, place
        ids = rows.column("ids")[own]
        return pa.table(
            {
                "doc_id": pa.array(ids.as_py(), kind),
                "held_out": pa.array(held_out, pa.bool_()),
                "n_tokens": pa.array(sizes, pa.int64()),
                "n_known": pa.array(np.add.reduceat((count > 0)[predicted].astype(np.int64), starts)),
                "train_tokens": pa.array(np.full(len(sizes), taught), pa.int64()),
                "base_score": pa.array(np.add.reduceat(np.log10(unigram)[predicted], starts)),
                "score": pa.array(np.add.reduceat(scores, starts)),
            }
        )

    return run


def language_model_scores(
    docs: DataFrame,
    learn: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    discount: float = DISCOUNT,
    batch_bytes: int = BATCH_BYTES,
    shard_tokens: int = SHARD_TOKENS,
    workspace: Workspace | None = None,
) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    The model learns from the rows where `learn` is true and scores all rows. Tokens are the
    words between white space, A-Z in lower case, then one end; `n_known` counts the tokens
    that were learned, `train_tokens` all learned ones. `base_score` is the log10 probability
    by unigrams plus one, `score` that of the model; both include the end.

    A null text counts as empty and has the end alone. A null `learn` counts as false. Null
    and repeated ids pass through; every row is learned and scored as a document of its own.
    Where nothing is learned, all words are unknown and have probability one. A text of any
    length is read whole, in a batch of its own if it is longer than one. An empty table gives
    an empty result; other columns are not read.
    """
    spark = text_session(docs.sparkSession)
    workspace = workspace or Workspace(spark)
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        text_or_empty(text_col).alias("text"),
        F.coalesce(learn, F.lit(False)).alias("learned"),
    )
    kind = rows.schema["doc_id"].dataType
    columns = f"batch long, taught long, ids array<{kind.simpleString()}>, hashes binary, body binary"
    batches = workspace.save(rows.mapInArrow(_read_batches(batch_bytes), columns), "batches")
    taught = batches.agg(F.sum("taught")).first()[0] or 0
    shards = max(1, -(-taught // shard_tokens))
    hot = _hot_words(batches, taught, shards) if shards > 1 else {}
    answers = workspace.save(
        batches.select("batch", "hashes", "body")
        .mapInArrow(_questions(shards, hot), "batch long, shard long, question binary")
        .groupBy("shard")
        .applyInArrow(
            _answers(shards, hot, discount), "batch long, shard long, answer binary, words long"
        ),
        "answers",
    )
    distinct = answers.agg(F.sum("words")).first()[0] or 0
    waiting = batches.select("batch", "ids", "body").unionByName(
        answers.filter("batch is not null").select("batch", "shard", "answer"),
        allowMissingColumns=True,
    )
    from pyspark.sql.pandas.types import to_arrow_type

    return waiting.groupBy("batch").applyInArrow(
        _scored(shards, taught, distinct, discount, to_arrow_type(kind)),
        f"doc_id {kind.simpleString()}, held_out boolean, n_tokens long, n_known long, "
        "train_tokens long, base_score double, score double",
    )


def op11_lm_scores(spark: SparkSession, folder: str) -> DataFrame:
    rest = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7
    return language_model_scores(
        table(spark, folder, "documents"), learn=F.coalesce(rest, F.lit(0)) != 2
    )
