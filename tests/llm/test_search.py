"""Ranked search against scores of all documents, by brute force."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from starloom.llm.lexical_search import (
    POSTINGS,
    Postings,
    PostingsWriter,
    best_of_shard,
    impact,
    ranked_search,
    terms_of,
)

SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return TERM.findall((text or "").translate(SMALL))


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=40))
def test_terms(text):
    assert [term.decode() for term in terms_of(text)] == plain_terms(text)


def brute_force(items, docs, best=10):
    terms = [(doc_id, Counter(plain_terms(text))) for doc_id, text in docs]
    some = [(doc_id, own) for doc_id, own in terms if own]
    n_docs, n_terms = len(some), sum(sum(own.values()) for _, own in some)
    holding = Counter(term for _, own in some for term in own)
    rows = []
    for item_id, text in items:
        scores = []
        for doc_id, own in some:
            m = 100 - 90 + (90 * sum(own.values()) * n_docs) // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holding[term] + 1)))
                * ((10**9 * own[term]) // (1000 * own[term] + 8 * m))
                for term in set(plain_terms(text))
                if term in own
            )
            if score > 0:
                scores.append((-score, doc_id is None, doc_id))
        scores.sort()
        rows += [
            (item_id, rank + 1, doc_id, -score)
            for rank, (score, _, doc_id) in enumerate(scores[:best])
        ]
    return sorted(rows, key=str)


def searched(spark, items, docs, **sizes):
    asked = spark.createDataFrame(items, "item_id long, text string")
    rows = spark.createDataFrame(docs, "doc_id long, text string, item int, rank map<string,int>")
    rows = rows.repartition(3)
    found = ranked_search(asked, rows, **sizes).collect()
    return sorted([tuple(row) for row in found], key=str)


def wide(docs):
    return [(doc_id, text, 1, {"a": 1}) for doc_id, text in docs]


@pytest.mark.parametrize("shard_bytes, items_bytes", [(1 << 24, 1 << 23), (4000, 50), (1, 1)])
def test_against_brute_force(spark, shard_bytes, items_bytes):
    random = np.random.default_rng(5)
    words = [f"w{k}" for k in range(60)]
    share = 1 / np.arange(1, 61)
    docs = [
        (k, " ".join(random.choice(words, random.integers(1, 60), p=share / share.sum())))
        for k in range(300)
    ]
    # many equal scores, and a word that a third of all documents hold
    docs += [(1000 - k, "Twin, TWIN w3!") for k in range(40)]
    docs += [(2000 + k, "hot") for k in range(150)]
    items = [(k, " ".join(random.choice(words, 8))) for k in range(12)]
    items += [(50, "twin"), (51, "hot w59"), (52, "w1 w2 hot twin w40 w41")]
    found = searched(spark, items, wide(docs), shard_bytes=shard_bytes, items_bytes=items_bytes)
    assert found == brute_force(items, docs)


def test_odd_rows(spark):
    docs = [
        (1, None),
        (2, ""),
        (3, "... !?"),
        (4, "Émile É émile"),
        (None, "apple pie"),
        (5, "apple pie"),
        (6, "apple pie"),
        (6, "apple pie"),
        (7, "x-y_z 1st " + "long " * 50_000 + "y" * 100_000),
    ]
    items = [(1, None), (None, "apple"), (2, "absent words"), (3, "É y 1st APPLE"), (3, "Long z")]
    found = searched(spark, items, wide(docs))
    assert found == brute_force(items, docs)


def test_empty_tables(spark):
    assert searched(spark, [], wide([(1, "a")])) == []
    assert searched(spark, [(1, "a")], []) == []


def test_blocks_are_rejected_unread():
    """A list of a frequent term is not decompressed where it cannot lift a candidate."""
    n = 50 * POSTINGS
    rare = np.arange(10) * 7
    term = np.concatenate([np.zeros(n, dtype=np.int64), np.ones(10, dtype=np.int64)])
    document = np.concatenate([np.arange(n), rare])
    times = np.concatenate([np.ones(n, dtype=np.int64), np.full(10, 5)])
    sizes = np.full(n, 20)
    written = PostingsWriter(term, document, times, sizes)
    norm = np.full(n, 100)
    common, seldom = (
        Postings(heads, written.body, weight, norm, lambda s: np.full(len(s), 100))
        for heads, weight in ((written.heads[:50], 3), (written.heads[50:], 6000))
    )
    found, scores = best_of_shard([common, seldom], n, 10)
    assert sorted(found.tolist()) == rare.tolist()
    five, one = (int(impact(w, np.array([t]), np.array([100]))[0]) for w, t in ((6000, 5), (3, 1)))
    assert (scores == five + one).all()
    assert set(common.blocks) == {0} and common.whole is None
