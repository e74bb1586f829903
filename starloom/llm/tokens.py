"""Token ids in Python workers, from the vocabulary files of public tokenizers.

Loaded vocabularies stay with the worker process between tasks.
"""

from __future__ import annotations

import json
import os
import re
import struct
import sys
import types
from collections.abc import Callable, Iterable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WORD_VOCABULARY = "word_bpe_49k.json"
BYTE_VOCABULARY = "byte_bpe_50k.json"
BYTE_RANKS = "byte_bpe_50k.tiktoken"

# longer texts of the byte-level vocabulary are worked on in pieces of about this many bytes
PIECE_BYTES = 1 << 20
# bytes of new words in a call of the library, and of the texts worked on together
_CALL_BYTES = 1 << 18
_GROUP_BYTES = 8 << 20
# words a worker remembers, at about 200 bytes each
_MOST_WORDS = 1_000_000
# ASCII symbols; an apostrophe may belong to the letters after it
_SYMBOLS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
# a symbol after these letters or a digit starts a token
_BEFORE_SYMBOLS = "[0-9a-z\u00df-\u00f6\u00f8-\u00ff]$"


def vocabulary_path(name: str) -> str:
    """A path as it stands; a bare file name lies with the public tokenizers."""
    if os.path.dirname(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def per_worker(key: str, make: Callable):
    """What `make` gives, made once in each worker process."""
    # functions travel to the workers by value, so their module's globals do not last
    holder = sys.modules.setdefault("_starloom_worker", types.ModuleType("_starloom_worker"))
    if not hasattr(holder, key):
        setattr(holder, key, make())
    return getattr(holder, key)


def forget_in_worker(key: str) -> None:
    """Let go of what `per_worker` keeps in this process; it is made anew when next asked for."""
    holder = sys.modules.get("_starloom_worker")
    if hasattr(holder, key):
        delattr(holder, key)


def load_tokenizer(vocabulary: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return per_worker(
        f"tokenizer {vocabulary}", lambda: Tokenizer.from_file(vocabulary_path(vocabulary))
    )


def _byte_letters() -> dict[int, str]:
    """The characters that stand for bytes in byte-level vocabularies.

    Visible bytes stand for themselves, the others in order for U+0100 and on.
    """
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [byte for byte in range(256) if byte not in visible]
    return {byte: chr(0x100 + place) for place, byte in enumerate(hidden)}


_BYTE_LETTERS = _byte_letters()


class WordCoder:
    """Token ids of a vocabulary whose tokens never cross white space.

    Arrow splits the texts at white space and finds the different words, a few MB at a time,
    so Python sees each of these once. Symbols that end a word after a letter or digit
    are a part of their own, as in the vocabulary's own rule. Parts that were not seen before
    are encoded in calls of about equal bytes; the others are looked up.
    """

    def __init__(self, vocabulary: str):
        self.tokenizer = load_tokenizer(vocabulary)
        small = self.tokenizer.get_vocab_size() <= 1 << 16
        self.kind = np.dtype("<u2" if small else "<u4")
        self.codes: dict[bytes, bytes] = {b"": b""}
        # packing by number of ids
        self._forms: dict[int, Callable] = {}
        self._small_letters = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+").fullmatch
        # U+0300 to U+037F start with these bytes; other marks may stand before them
        self._capital_and_mark = re.compile(rb"[A-Z][\x80-\xff]*[\xcc\xcd]").search
        self._word = re.compile(rb"\S+")

    @staticmethod
    def loaded(vocabulary: str) -> WordCoder:
        return per_worker(f"words {vocabulary}", lambda: WordCoder(vocabulary))

    @staticmethod
    def forget(vocabulary: str) -> None:
        forget_in_worker(f"words {vocabulary}")

    def _lower(self, word: re.Match) -> bytes:
        return word[0] if self._capital_and_mark(word[0]) else word[0].lower()

    def _lowered(self, texts: pa.Array) -> pa.Array:
        # the vocabulary is in lower case; only special strings must keep theirs, and words
        # whose capitals a mark may follow: the vocabulary composes both before it lowers
        lowered = pc.ascii_lower(texts)
        odd = pc.match_substring_regex(texts, "<\\||[\u0300-\u037f]")
        if not pc.any(odd).as_py():
            return lowered
        kept = [text.encode("utf-8") for text in texts.filter(odd).to_pylist()]
        kept = [text if b"<|" in text else self._word.sub(self._lower, text) for text in kept]
        return pc.replace_with_mask(
            lowered, odd, pa.array([text.decode("utf-8") for text in kept], lowered.type)
        )

    def _packed(self, ids: list[int]) -> bytes:
        form = self._forms.get(len(ids))
        if form is None:
            letter = "H" if self.kind.itemsize == 2 else "I"
            form = self._forms[len(ids)] = struct.Struct(f"<{len(ids)}{letter}").pack
        return form(*ids)

    def _learn(self, new: set[bytes]) -> None:
        # small letters to U+00FF need no normalising or splitting: the model alone gives
        # their tokens, from the characters that stand for their bytes
        plain = [word for word in new if self._small_letters(word)]
        codes, packed, tokenize = self.codes, self._packed, self.tokenizer.model.tokenize
        for word in plain:
            # a letter of ASCII stands for itself
            letters = word.decode("latin-1")
            tokens = tokenize(letters if word.isascii() else letters.translate(_BYTE_LETTERS))
            codes[word] = packed([token.id for token in tokens])
        for call in calls(new.difference(plain), _CALL_BYTES):
            texts = [word.decode("utf-8") for word in call]
            found = self.tokenizer.encode_batch(texts, add_special_tokens=False)
            for word, encoding in zip(call, found, strict=True):
                self.codes[word] = self._packed(encoding.ids)

    def _codes(self, words: list[bytes]) -> list[bytes]:
        if len(self.codes) > _MOST_WORDS:
            self.codes = {b"": b""}
        found = list(map(self.codes.get, words))
        new = {word for word, code in zip(words, found, strict=True) if code is None}
        self._learn(new)
        return list(map(self.codes.__getitem__, words)) if new else found

    @staticmethod
    def _parts(words: pa.Array) -> tuple[list[bytes], np.ndarray]:
        """Different parts of words, and two places among them a word; the second may be empty."""
        stems = pc.ascii_rtrim(words, characters=_SYMBOLS)
        ended = pc.and_not(
            pc.match_substring_regex(stems, _BEFORE_SYMBOLS), pc.match_substring(words, "<|")
        )
        cut = pc.and_(ended, pc.not_equal(pc.binary_length(stems), pc.binary_length(words)))
        stems = pc.if_else(cut, stems, words).dictionary_encode()
        parts = stems.dictionary.cast(pa.binary()).to_pylist()
        places = np.full((len(words), 2), len(parts), dtype="<i4")
        places[:, 0] = stems.indices.to_numpy()
        whole = words.filter(cut).cast(pa.binary()).to_pylist()
        cut = cut.to_numpy(zero_copy_only=False)
        tails = {b"": len(parts)}
        places[cut, 1] = [
            tails.setdefault(word[len(parts[stem]) :], len(parts) + len(tails))
            for word, stem in zip(whole, places[cut, 0].tolist(), strict=True)
        ]
        return [*parts, *tails], places

    def _coded(
        self, texts: Iterable[str] | pa.Array
    ) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]]:
        """A few MB of texts at a time.

        The codes of the parts of words, the places of each different word's two parts, the
        place of each word of the texts among the different ones, the borders of the texts.
        """
        if not isinstance(texts, pa.Array):
            texts = pa.array(texts, pa.string())
        sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
        start = 0
        while start < len(texts):
            most = _GROUP_BYTES + (sizes[start - 1] if start else 0)
            stop = max(start + 1, int(np.searchsorted(sizes, most, "right")))
            split = pc.ascii_split_whitespace(self._lowered(texts.slice(start, stop - start)))
            borders = split.offsets.to_numpy()
            words = split.values.dictionary_encode()
            del split
            parts, places = self._parts(words.dictionary)
            yield self._codes(parts), places, words.indices.to_numpy(), borders
            start = stop

    def _sizes(self, codes: list[bytes]) -> np.ndarray:
        return np.fromiter(map(len, codes), "<i4", len(codes)) // self.kind.itemsize

    def encode(self, texts: Iterable[str] | pa.Array) -> list[np.ndarray]:
        found = []
        for codes, parts, words, borders in self._coded(texts):
            flat = np.frombuffer(b"".join(codes), dtype=self.kind)
            flat, ends = _joined(flat, self._sizes(codes), parts.reshape(-1))
            ids, ends = _joined(flat, np.diff(ends[::2]), words)
            found += [ids[a:b] for a, b in pairwise(ends[borders].tolist())]
        return found

    def count(self, texts: Iterable[str] | pa.Array) -> list[int]:
        found = []
        for codes, parts, words, borders in self._coded(texts):
            sizes = self._sizes(codes)[parts].sum(axis=1)
            ends = np.concatenate([[0], np.cumsum(sizes[words])])
            found += np.diff(ends[borders]).astype(int).tolist()
        return found


def _joined(flat: np.ndarray, sizes: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pieces of `flat` at the places, one after the other, and their borders."""
    begins = np.cumsum(sizes, dtype="<i4") - sizes
    lengths = sizes[places]
    borders = np.zeros(len(places) + 1, dtype="<i4")
    np.cumsum(lengths, out=borders[1:])
    taken = np.repeat(begins[places] - borders[:-1], lengths)
    taken += np.arange(len(taken), dtype="<i4")
    return flat[taken], borders


def calls(items: Iterable[bytes], limit: int) -> Iterator[list[bytes]]:
    """The items in lists of about `limit` bytes; a longer item is a list of its own."""
    call: list[bytes] = []
    size = 0
    for item in items:
        if call and size + len(item) > limit:
            yield call
            call, size = [], 0
        call.append(item)
        size += len(item)
    if call:
        yield call


def load_ranks(ranks: str):
    """A byte-level vocabulary from its rank file; no string is special to it."""
    import base64

    import public_tokenizers
    import tiktoken

    with open(vocabulary_path(ranks), "rb") as file:
        merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding(
        "byte-level", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens={}
    )


def _added_strings(vocabulary: str) -> list[str]:
    with open(vocabulary_path(vocabulary), encoding="utf-8") as file:
        return [token["content"] for token in json.load(file)["added_tokens"]]


class ByteCoder:
    """Token ids of the byte-level vocabulary.

    Its rank file holds the same vocabulary for a faster library. Texts with a special
    token's string, which that library takes as ordinary text, go to the first one.
    """

    # a blank between letters starts a token in any case
    _SAFE = re.compile(r"(?<=[A-Za-z]) (?=[A-Za-z])")

    def __init__(self, vocabulary: str, ranks: str):
        self.vocabulary = vocabulary
        self.special = _added_strings(vocabulary)
        self.fast = load_ranks(ranks)

    @staticmethod
    def loaded(vocabulary: str, ranks: str) -> ByteCoder:
        return per_worker(f"bytes {vocabulary} {ranks}", lambda: ByteCoder(vocabulary, ranks))

    def encode(self, text: str) -> np.ndarray:
        if any(special in text for special in self.special):
            # loaded for the first such text only, as a worker would hold the vocabulary twice
            tokenizer = load_tokenizer(self.vocabulary)
            ids = tokenizer.encode(text, add_special_tokens=False).ids
            return np.array(ids, dtype="<u4")
        parts = []
        start = 0
        while len(text) - start > PIECE_BYTES:
            cut = self._SAFE.search(text, start + PIECE_BYTES)
            if cut is None:
                break
            parts.append(self.fast.encode_to_numpy(text[start : cut.start()]))
            start = cut.start()
        parts.append(self.fast.encode_to_numpy(text[start:]))
        return np.concatenate(parts).astype("<u4", copy=False)
