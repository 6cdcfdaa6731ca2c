"""Hash the words of many texts at once with numpy, and put the hashes together as word n-grams.

A word's hash is a polynomial over a fixed table of random 64-bit values, one for each byte value. Sums over
a whole buffer give every word's value by two look-ups, so no Python object is made for a word. Equal words
have equal hashes; two different ones agree with a probability of about 2**-63 times their length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np

_SEED = 0x5EED
_BUFFER_BYTES = 1 << 18  # texts are handled in buffers of about this size; a longer text has one of its own
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_random = np.random.default_rng(_SEED)
_BYTE_VALUES = _random.integers(0, 2**64, 256, dtype=np.uint64)
_BASE = np.uint64(int(_random.integers(0, 2**63)) * 2 + 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_GAP = re.compile(rb"[ \t-\r]")
_NEXT = re.compile(rb"[ \t-\r]*+[^ \t-\r]++")
_powers: dict[int, np.ndarray] = {}


def _power_table(base: np.uint64, size: int) -> np.ndarray:
    """Powers of a number; those for usual buffers are kept, longer tables are made for one use."""
    known = _powers.get(int(base))
    if known is None or len(known) < size:
        factors = np.full(max(size, 2 * _BUFFER_BYTES), base, dtype=np.uint64)
        factors[0] = 1
        known = np.cumprod(factors, dtype=np.uint64)
        if len(known) == 2 * _BUFFER_BYTES:
            _powers[int(base)] = known
    return known[:size]


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly, one to one."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def buffers(texts: Sequence[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges of texts whose joint size is about `_BUFFER_BYTES`; every range has at least one text."""
    first, size = 0, 0
    for place, text in enumerate(texts):
        if place > first and size + len(text) > _BUFFER_BYTES:
            yield first, place
            first, size = place, 0
        size += len(text) + 1
    if first < len(texts):
        yield first, len(texts)


def is_long(text: bytes) -> bool:
    """Whether a text is handled in pieces, so that memory does not grow with it."""
    return len(text) > 4 * _BUFFER_BYTES


def pieces(text: bytes, overlap: int) -> Iterator[bytes]:
    """A long text in pieces of about `4 * _BUFFER_BYTES`, cut between words; each begins with the last `overlap` words
    of the one before, so every run of one word more is whole in a piece. Only longer words make longer pieces."""
    start, size = 0, 4 * _BUFFER_BYTES
    while len(text) - start > size and (cut := _GAP.search(text, start + size)):
        end = cut.start()
        while (back := _last_words(text, start, end, overlap)) <= start and (more := _NEXT.match(text, end)):
            end = more.end()
        if back <= start:
            break
        yield text[start:end]
        start = back
    yield text[start:]


def _last_words(text: bytes, start: int, end: int, number: int) -> int:
    for _ in range(number):
        end = start + len(text[start:end].rstrip())
        end = max(text.rfind(space, start, end) for space in (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r")) + 1
        if end <= start:
            break
    return end


class Words:
    """The words of some texts: `bounds[i]:bounds[i + 1]` are the places of text i's words."""

    def __init__(self, texts: Sequence[bytes]):
        buffer = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
        inside = ~_SPACE[buffer]
        edges = np.flatnonzero(np.diff(inside.view(np.int8), prepend=0))
        self.starts, self.ends = edges[0::2], edges[1::2]  # the buffer ends with a space, so edges come in pairs
        self._sums = np.zeros(len(buffer) + 1, dtype=np.uint64)
        np.cumsum(_BYTE_VALUES[buffer] * _power_table(_BASE, len(buffer)), out=self._sums[1:], dtype=np.uint64)
        self._shift = _power_table(_INVERSE, len(buffer))
        lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        text_starts = np.concatenate([[0], np.cumsum(lengths + 1)])
        self.bounds = np.searchsorted(self.starts, text_starts)

    def hashes(self, first_bytes: int | None = None) -> np.ndarray:
        """A hash of each word, or of its first bytes only."""
        ends = self.ends if first_bytes is None else np.minimum(self.ends, self.starts + first_bytes)
        return mix((self._sums[ends] - self._sums[self.starts]) * self._shift[self.starts])


def chain(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A hash of two hashes in this order."""
    return mix(left * np.uint64(0x9E3779B97F4A7C15) + right)


def _grams(single: np.ndarray, words: int) -> np.ndarray:
    """Hashes of all runs of so many words."""
    grams = single[: max(0, len(single) - words + 1)]
    for ahead in range(1, words):
        grams = chain(grams, single[ahead : len(single) - words + 1 + ahead])
    return grams


def shingle_sets(texts: Sequence[str | None], words: int) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its word n-grams.

    A-Z are lower-cased and words are runs of anything but ASCII white space. A text with fewer words gives
    the whole sequence as one shingle, a text without words none. Long texts are read in overlapping pieces.
    """
    encoded = [(text or "").encode("utf-8", "surrogatepass").lower() for text in texts]
    for first, last in buffers(encoded):
        if is_long(encoded[first]) and (parts := [np.unique(_grams(Words([piece]).hashes(), words)) for piece in pieces(encoded[first], words - 1)]):
            whole = np.unique(np.concatenate(parts))
            if len(whole):
                yield whole
                continue
        found = Words(encoded[first:last])
        single = found.hashes()
        grams = _grams(single, words)
        for start, end in zip(found.bounds[:-1], found.bounds[1:], strict=True):
            count = int(end - start)
            if count >= words:
                values = np.sort(grams[start : end - words + 1])
                yield values[np.concatenate([[True], values[1:] != values[:-1]])]
            elif count:
                whole = np.array([count], dtype=np.uint64)
                for place in range(start, end):
                    whole = chain(whole, single[place : place + 1])
                yield whole
            else:
                yield np.empty(0, dtype=np.uint64)
