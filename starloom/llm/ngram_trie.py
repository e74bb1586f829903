"""An n-gram trie in Elias-Fano levels, laid out in one buffer and read through a memory map.

A monotone sequence of n numbers below u is split into its low bits, packed, and its high
bits, in unary: a one for every number, a zero wherever the high part grows. Both take about
2 + log2(u / n) bits a number, and a search needs only the zeros around one high part.

Levels of the trie, for the words of one shard:

    words       the words' 64-bit hashes in order (Elias-Fano); a word is its place
    pointers    for each word the place of its first follower (Elias-Fano)
    followers   for each word the places of the words after it in order, each raised by the
                last number of the word before, so that the level is monotone (Elias-Fano)
    codes       one byte for each follower: its quantised discounted probability

A follower is found by a successor search relative to its context: the context's base is
added to the word, and the first number not below it is compared.
"""

from __future__ import annotations

import mmap
import struct

import numpy as np

_ONE = np.uint64(1)
_ALL = np.uint64(0xFFFF_FFFF_FFFF_FFFF)

# probabilities from 1 down to 10^-12, closest together at 1; 0 is "not there"
CODES = 255
_DECADES = 12.0


def quantised(probability: np.ndarray) -> np.ndarray:
    decades = -np.log10(np.clip(probability, 10.0**-_DECADES, 1.0))
    return (np.rint(np.sqrt(decades / _DECADES) * (CODES - 1)) + 1).astype(np.uint8)


def probabilities() -> np.ndarray:
    """The probability of each code."""
    decades = _DECADES * (np.arange(CODES) / (CODES - 1)) ** 2
    return np.concatenate([[0.0], 10.0**-decades])


def _bit_of_byte() -> np.ndarray:
    """Place of the k-th one of a byte, as table[byte, k]."""
    bits = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
    table = np.zeros((256, 8), dtype=np.uint8)
    byte, place = np.nonzero(bits)
    rank = np.cumsum(bits, axis=1)[byte, place] - 1
    table[byte, rank] = place
    return table


_BIT = _bit_of_byte()


def _select_in(words: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Place of the rank-th one (from 0) within each 64-bit word."""
    parts = words.view(np.uint8).reshape(-1, 8)
    ones = np.cumsum(np.bitwise_count(parts), axis=1, dtype=np.int64)
    byte = (ones <= rank[:, None]).sum(axis=1)
    row = np.arange(len(words))
    before = np.where(byte > 0, ones[row, byte - 1], 0)
    return byte * 8 + _BIT[parts[row, byte], rank - before]


class EliasFano:
    """A monotone sequence; all queries take and give arrays."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray):
        self.n, self.low_bits, self.low, self.high = n, low_bits, low, high
        ones = np.bitwise_count(high).astype(np.int64)
        # ones and zeros before each word of the high bits
        self.ones = np.concatenate([[0], np.cumsum(ones)])
        self.zeros = np.arange(len(self.ones)) * 64 - self.ones

    @staticmethod
    def of(numbers: np.ndarray) -> EliasFano:
        numbers = np.asarray(numbers, dtype=np.uint64)
        n = len(numbers)
        top = int(numbers[-1]) if n else 0
        bits = min(63, max(0, ((top + 1) // max(n, 1)).bit_length() - 1))
        highs = (numbers >> np.uint64(bits)).astype(np.int64)
        # one zero ends each high part, the last included
        length = n + (top >> bits) + 1
        flags = np.zeros(-(-length // 64) * 64, dtype=bool)
        flags[highs + np.arange(n)] = True
        high = np.packbits(flags, bitorder="little").view(np.uint64)
        low = np.zeros(-(-n * bits // 64) + 1, dtype=np.uint64)
        if bits:
            least = numbers & ((_ONE << np.uint64(bits)) - _ONE)
            at = np.arange(n, dtype=np.uint64) * np.uint64(bits)
            word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            np.bitwise_or.at(low, word, least << shift)
            over = shift + np.uint64(bits) > 64
            np.bitwise_or.at(low, word[over] + 1, least[over] >> (np.uint64(64) - shift[over]))
        return EliasFano(n, bits, low, high)

    def _low(self, place: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(place), dtype=np.uint64)
        at = place.astype(np.uint64) * np.uint64(self.low_bits)
        word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
        found = self.low[word] >> shift
        over = shift + np.uint64(self.low_bits) > 64
        found[over] |= self.low[word[over] + 1] << (np.uint64(64) - shift[over])
        return found & ((_ONE << np.uint64(self.low_bits)) - _ONE)

    def _select(self, before: np.ndarray, flip: bool, rank: np.ndarray) -> np.ndarray:
        word = np.searchsorted(before, rank, side="right") - 1
        bits = self.high[word]
        return word * 64 + _select_in(bits ^ _ALL if flip else bits, rank - before[word])

    def at(self, place: np.ndarray) -> np.ndarray:
        """The numbers at some places."""
        high = (self._select(self.ones, False, place) - place).astype(np.uint64)
        return high << np.uint64(self.low_bits) | self._low(place)

    def _first_of(self, high: np.ndarray) -> np.ndarray:
        """Place of the first number whose high part is not below `high`."""
        first = np.zeros(len(high), dtype=np.int64)
        some = high > 0
        most = int(self.zeros[-1])
        rank = np.minimum(high[some], most) - 1
        first[some] = self._select(self.zeros, True, rank) - rank
        return np.minimum(first, self.n)

    def successor(self, numbers: np.ndarray) -> np.ndarray:
        """Place of the first number that is not below each given one; n if there is none."""
        numbers = np.asarray(numbers, dtype=np.uint64)
        high = (numbers >> np.uint64(self.low_bits)).astype(np.int64)
        low = numbers & ((_ONE << np.uint64(self.low_bits)) - _ONE)
        start, end = self._first_of(high), self._first_of(high + 1)
        # halve the range of one high part until it is empty
        while True:
            open_ = np.flatnonzero(start < end)
            if not len(open_):
                return start
            middle = (start[open_] + end[open_]) >> 1
            below = self._low(middle) < low[open_]
            start[open_[below]] = middle[below] + 1
            end[open_[~below]] = middle[~below]

    def parts(self) -> list[np.ndarray]:
        head = np.array([self.n, self.low_bits, len(self.low), len(self.high)], dtype=np.uint64)
        return [head, self.low, self.high]

    @staticmethod
    def read(view: np.ndarray, at: int) -> tuple[EliasFano, int]:
        n, bits, low, high = (int(x) for x in view[at : at + 4])
        at += 4
        found = EliasFano(n, bits, view[at : at + low], view[at + low : at + low + high])
        return found, at + low + high


def trie_bytes(
    words: np.ndarray, context: np.ndarray, follower: np.ndarray, codes: np.ndarray
) -> bytes:
    """The levels in one buffer; pairs of places in `words`, sorted and each once."""
    sizes = np.bincount(context, minlength=len(words))
    pointers = np.concatenate([[0], np.cumsum(sizes)])
    some = np.flatnonzero(sizes)
    last = follower[pointers[some + 1] - 1].astype(np.uint64) + _ONE
    base = np.zeros(len(words), dtype=np.uint64)
    base[some] = np.cumsum(last) - last
    levels = [
        EliasFano.of(words),
        EliasFano.of(pointers),
        EliasFano.of(follower.astype(np.uint64) + base[context]),
    ]
    body = b"".join(part.tobytes() for level in levels for part in level.parts())
    return struct.pack("<QQ", len(body), len(codes)) + body + codes.tobytes()


class NgramTrie:
    """Answers from the mapped levels; only the counts of ones per word are added to them."""

    def __init__(self, buffer: bytes):
        # anonymous memory, as a local file would stay behind on the executor
        self.map = mmap.mmap(-1, max(len(buffer), 1))
        self.map.write(buffer)
        body, n_codes = struct.unpack_from("<QQ", self.map)
        view = np.frombuffer(self.map, np.uint64, body // 8, 16)
        self.words, at = EliasFano.read(view, 0)
        self.pointers, at = EliasFano.read(view, at)
        self.followers, _ = EliasFano.read(view, at)
        self.codes = np.frombuffer(self.map, np.uint8, n_codes, 16 + body)

    def place(self, hashes: np.ndarray) -> np.ndarray:
        """Places of words that are all in the trie."""
        return self.words.successor(hashes)

    def types(self, place: np.ndarray) -> np.ndarray:
        """How many different followers each word has."""
        return (self.pointers.at(place + 1) - self.pointers.at(place)).astype(np.int64)

    def code(self, context: np.ndarray, follower: np.ndarray) -> np.ndarray:
        """Code of each pair of places, 0 where the pair is not in the trie."""
        codes = np.zeros(len(context), dtype=np.uint8)
        start = self.pointers.at(context).astype(np.int64)
        end = self.pointers.at(context + 1).astype(np.int64)
        base = np.zeros(len(context), dtype=np.uint64)
        later = start > 0
        base[later] = self.followers.at(start[later] - 1) + _ONE
        wanted = base + follower.astype(np.uint64)
        found = self.followers.successor(wanted)
        inside = np.flatnonzero(found < end)
        same = self.followers.at(found[inside]) == wanted[inside]
        codes[inside[same]] = self.codes[found[inside[same]]]
        return codes
