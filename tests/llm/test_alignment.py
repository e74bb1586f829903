"""Alignment against both libraries on whole texts, and counts by brute force."""

import hashlib
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import example, given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from starloom.llm.alignment import PIECE_MODEL, Aligner, alignment_measures, op13_alignment
from starloom.llm.tokens import BYTE_RANKS, _byte_letters

FOLDER = "/root/testdata/sf0.001"
FIRST = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
FIRST.encode_special_tokens = True
SECOND = sentencepiece.SentencePieceProcessor(
    model_file=public_tokenizers.path("piece_bpe_32k.model")
)
BYTE_OF = {chr(byte): byte for byte in range(256)}
BYTE_OF |= {letter: byte for byte, letter in _byte_letters().items()}


def first_tokens(text):
    encoding = FIRST.encode(text, add_special_tokens=False)
    return encoding.ids, [bytes(BYTE_OF[letter] for letter in token) for token in encoding.tokens]


def second_tokens(text):
    ids = SECOND.encode(text)
    found = []
    for number in ids:
        piece = SECOND.id_to_piece(number)
        if SECOND.is_byte(number):
            found.append(bytes([int(piece[3:5], 16)]))
        else:
            found.append(piece.replace("▁", " ").encode())
    return ids, found


def plain(text):
    """Groups and links from the whole text, or None."""
    if not text:
        return None
    (a, a_bytes), (b, b_bytes) = first_tokens(" " + text), second_tokens(text)
    if not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
        return None

    def ends(parts):
        at, found = 0, []
        for part in parts:
            at += len(part)
            found.append(at)
        return found

    a_ends, b_ends = ends(a_bytes), ends(b_bytes)
    links = [(x, y) for x, p in zip(a, a_ends, strict=True) for y, q in zip(b, b_ends, strict=True) if p == q]
    groups, before = [], 0
    for cut in sorted(set(a_ends) & set(b_ends)):
        left = [str(x) for x, p in zip(a, a_ends, strict=True) if before < p <= cut]
        right = [str(y) for y, q in zip(b, b_ends, strict=True) if before < q <= cut]
        groups.append(",".join(left) + "|" + ",".join(right))
        before = cut
    return len(a), len(b), links, ";".join(groups)


SAMPLE = st.text(
    alphabet=st.one_of(
        st.sampled_from(list(" \n\t'sStTrRéabcde.,!<>|_/019▁ 　́")),
        st.characters(exclude_categories=["Cs"]),
    ),
    min_size=1,
    max_size=40,
)


@settings(max_examples=1500, deadline=None)
@given(SAMPLE)
@example("<|endoftext|> <s> </s> <unk> <0x41>")
@example("one two\nthree\n\nfour  five \n six\tseven\n")
@example("\nstarts with a break")
@example(" it's 'tis x 's\n's don't\n'll")
@example("a ▁ b")
def test_words_give_the_tokens_of_the_text(text):
    aligner = Aligner.loaded(BYTE_RANKS, PIECE_MODEL)
    wanted, found = plain(text), aligner.align(text)
    if wanted is None:
        assert found is None
        return
    n_a, n_b, links, groups = wanted
    assert sum(word[0] for word in found) == n_a and sum(word[1] for word in found) == n_b
    assert sum(word[2] for word in found) == len(links)
    assert b"".join(word[4] for word in found)[:-1].decode() == groups


def brute_force(rows):
    aligned = [(doc_id, plain(text)) for doc_id, text in rows]
    counts = Counter(link for _, own in aligned if own for link in own[2])
    highest = {}
    for (_, b), n in counts.items():
        highest[b] = max(highest.get(b, 0), n)
    found = []
    for doc_id, own in aligned:
        if own is None:
            found.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, links, groups = own
        best = sum(counts[link] == highest[link[1]] for link in links)
        total = sum(counts[link] for link in links)
        cut = hashlib.sha256(groups.encode()).hexdigest()
        found.append((doc_id, n_a, n_b, groups.count(";") + 1, len(links), best, total, cut))
    return sorted(found, key=str)


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    short = [(row["doc_id"], row["text"]) for row in docs]
    # pairs of tokens are quadratic in the plain version, so it is asked for the shorter texts
    wanted = {row[0]: row for row in brute_force([row for row in short if len(row[1]) < 400])}
    found = {row["doc_id"]: tuple(row) for row in op13_alignment(spark, FOLDER).collect()}
    assert sorted(found) == sorted(doc_id for doc_id, _ in short)
    for doc_id, row in wanted.items():
        assert found[doc_id][:5] == row[:5] and found[doc_id][7] == row[7]


ODD = [
    (1, None),
    (2, ""),
    (2, "twice"),
    (None, "twice"),
    (3, "Same words, same counts"),
    (3, "Same words, same counts"),
    (4, "a▁b is not given back"),
    (5, "tabs\tand  blanks \n\n é \U0001f600 <|endoftext|>"),
    (6, "words " * 300 + "y" * 300),
    (7, "same Words, same Counts"),
]


def test_odd_rows_against_brute_force(spark):
    schema = "doc_id long, text string, links string, digest map<string,int>, copies int"
    docs = spark.createDataFrame([(*row, "x", {"a": 1}, 1) for row in ODD], schema)
    found = alignment_measures(docs.repartition(3)).collect()
    assert sorted((tuple(row) for row in found), key=str) == brute_force(ODD)
    assert alignment_measures(docs.limit(0)).collect() == []


def test_a_text_that_many_documents_share(spark):
    rows = [(k, "the hot text") for k in range(400)] + [(1000 + k, f"text {k} the") for k in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    found = alignment_measures(docs).collect()
    assert sorted((tuple(row) for row in found), key=str) == brute_force(rows)


@pytest.mark.parametrize("most", [1, 50])
def test_forgotten_words(monkeypatch, most):
    monkeypatch.setattr("starloom.llm.alignment.MOST_WORDS", most)
    aligner = Aligner(BYTE_RANKS, PIECE_MODEL)
    for text in ("one two three", "two four five six", "one two"):
        found = aligner.align(text)
        assert b"".join(word[4] for word in found)[:-1].decode() == plain(text)[3]
