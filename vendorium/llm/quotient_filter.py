"""Counting quotient filters over permuted keys: sorted, compact, and without loss.

A key is one or more 64-bit numbers. Its first number is put through a permutation of `bits`-bit numbers, so that keys
spread evenly and can be got back. The top bits of the permuted number say which shard it belongs to, the next ones are
the quotient, the rest and the further numbers of the key are the remainder, kept whole: no two keys share an entry.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator, Sequence

import numpy as np

Keys = list[np.ndarray]  # columns of uint64; the first is permuted and sorts first

_ODD = 0x9E3779B97F4A7C15
_HEAD = struct.Struct("<QBBBB")  # entries, bits, shard bits, quotient bits, further numbers
_MANY = 255  # a count of so many or more has its own 64-bit number at the end


def _mask(bits: int) -> np.uint64:
    return np.uint64((1 << bits) - 1)


def _shifted(values: np.ndarray, bits: int) -> np.ndarray:
    return values >> np.uint64(bits) if bits < 64 else np.zeros_like(values)


def permute(values: np.ndarray, bits: int) -> np.ndarray:
    """A fixed permutation of the numbers below 2**bits: odd products and folds, each of which can be undone."""
    mask, half = _mask(bits), np.uint64((bits + 1) // 2)
    for _ in range(2):
        values = (values * np.uint64(_ODD)) & mask
        values = values ^ (values >> half)
    return (values * np.uint64(_ODD)) & mask


def restore(values: np.ndarray, bits: int) -> np.ndarray:
    """The numbers that `permute` was given."""
    mask, half = _mask(bits), np.uint64((bits + 1) // 2)
    back = np.uint64(pow(_ODD, -1, 1 << bits) if bits else 1)
    for _ in range(2):
        values = (values * back) & mask
        values = values ^ (values >> half)
    return (values * back) & mask


def combine(keys: Keys, counts: np.ndarray) -> tuple[Keys, np.ndarray]:
    """Sorted distinct keys with summed counts. The sort merges runs that are sorted already."""
    if not len(counts):
        return keys, counts
    order = np.argsort(keys[0], kind="stable") if len(keys) == 1 else np.lexsort(keys[::-1])
    keys = [column[order] for column in keys]
    new = np.ones(len(counts), dtype=bool)
    new[1:] = np.any([column[1:] != column[:-1] for column in keys], axis=0)
    firsts = np.flatnonzero(new)
    return [column[firsts] for column in keys], np.add.reduceat(counts[order], firsts)


def pack(keys: Keys, counts: np.ndarray, bits: int, shard_bits: int) -> bytes:
    """One filter of sorted distinct keys of one shard, the first numbers permuted."""
    number, rest = len(counts), bits - shard_bits
    quotient_bits = min(rest, max(0, number.bit_length() - 1))
    left = rest - quotient_bits
    lead = keys[0] & _mask(rest)
    quotients = _shifted(lead, left).astype(np.int64)
    occupied = np.zeros(1 << quotient_bits, dtype=bool)
    occupied[quotients] = True
    ends = np.ones(number, dtype=bool)
    ends[:-1] = quotients[1:] != quotients[:-1]
    remainders = (lead & _mask(left)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, : -(-left // 8)]
    return b"".join([
        _HEAD.pack(number, bits, shard_bits, quotient_bits, len(keys) - 1),
        np.packbits(occupied).tobytes(), np.packbits(ends).tobytes(), remainders.tobytes(),
        *[column.astype("<u8").tobytes() for column in keys[1:]],
        np.minimum(counts, _MANY).astype(np.uint8).tobytes(), counts[counts >= _MANY].astype("<u8").tobytes(),
    ])


def unpack(raw: bytes, shard: int) -> tuple[Keys, np.ndarray]:
    """The keys and counts of a filter, sorted."""
    number, bits, shard_bits, quotient_bits, more = _HEAD.unpack_from(raw)
    rest, at = bits - shard_bits, _HEAD.size
    left = rest - quotient_bits

    def take(size: int) -> np.ndarray:
        nonlocal at
        at += size
        return np.frombuffer(raw, dtype=np.uint8, count=size, offset=at - size)

    occupied = np.flatnonzero(np.unpackbits(take(-(-(1 << quotient_bits) // 8)), count=1 << quotient_bits))
    ends = np.flatnonzero(np.unpackbits(take(-(-number // 8)), count=number)) + 1
    quotients = np.repeat(occupied, np.diff(ends, prepend=0)).astype(np.uint64)
    width = -(-left // 8)
    whole = np.zeros((number, 8), dtype=np.uint8)
    whole[:, :width] = take(number * width).reshape(number, width)
    lead = whole.view("<u8").reshape(-1).astype(np.uint64)
    if left < 64:
        lead |= quotients << np.uint64(left)
    if rest < 64:
        lead |= np.uint64(shard << rest)
    keys = [lead] + [take(8 * number).view("<u8").astype(np.uint64) for _ in range(more)]
    counts = take(number).astype(np.int64)
    counts[counts == _MANY] = take(8 * int((counts == _MANY).sum())).view("<u8").astype(np.int64)
    return keys, counts


def merge(filters: Iterable[bytes], shard: int) -> tuple[Keys, np.ndarray]:
    """The keys of several filters of one shard with summed counts."""
    parts = [unpack(raw, shard) for raw in filters]
    columns = [np.concatenate(column) for column in zip(*[keys for keys, _ in parts], strict=True)]
    return combine(columns, np.concatenate([counts for _, counts in parts]))


class Counter:
    """Counts keys in bounded memory; what no longer fits is given out as filters, one for each shard."""

    def __init__(self, bits: int, shard_bits: int, limit: int = 1 << 21):
        self.bits, self.shard_bits, self._limit = bits, min(shard_bits, bits), limit
        self._keys: list[Keys] = []
        self._counts: list[np.ndarray] = []
        self._size = 0

    def add(self, keys: Keys) -> Iterator[tuple[int, bytes]]:
        """Count each key once more; the first numbers are not permuted yet."""
        if len(keys[0]):
            self._keep([permute(keys[0], self.bits), *keys[1:]], np.ones(len(keys[0]), dtype=np.int64))
        if self._size > self._limit:
            self._compact()
            if 2 * self._size > self._limit:
                yield from self.filters()

    def _keep(self, keys: Keys, counts: np.ndarray) -> None:
        keys, counts = combine(keys, counts)
        self._keys.append(keys)
        self._counts.append(counts)
        self._size += len(counts)

    def _compact(self) -> None:
        columns = [np.concatenate(column) for column in zip(*self._keys, strict=True)]
        counts = np.concatenate(self._counts)
        self._keys, self._counts, self._size = [], [], 0
        self._keep(columns, counts)

    def filters(self) -> Iterator[tuple[int, bytes]]:
        """(shard, filter) of all that is counted, and start anew."""
        if not self._size:
            return
        self._compact()
        keys, counts = self._keys.pop(), self._counts.pop()
        self._size = 0
        shards = _shifted(keys[0], self.bits - self.shard_bits)
        cuts = np.flatnonzero(np.diff(shards)) + 1
        for first, last in zip(np.append(0, cuts).tolist(), np.append(cuts, len(counts)).tolist(), strict=True):
            own = [column[first:last] for column in keys]
            yield int(shards[first]), pack(own, counts[first:last], self.bits, self.shard_bits)


def occupied(keys: np.ndarray, bits: int, table_bits: int, shard_bits: int) -> bytes:
    """One shard's slice of a bit table: which of the top `table_bits` bits occur among permuted numbers."""
    table = np.zeros(1 << (table_bits - shard_bits), dtype=bool)
    table[(_shifted(keys, bits - table_bits) & _mask(table_bits - shard_bits)).astype(np.int64)] = True
    return np.packbits(table).tobytes()


def probed(table: np.ndarray, values: np.ndarray, bits: int, table_bits: int) -> np.ndarray:
    """Whether numbers may be among those of the table; never False for one that is."""
    place = _shifted(permute(values, bits), bits - table_bits)
    return (table[(place >> np.uint64(3)).astype(np.int64)] >> (7 - (place & np.uint64(7))).astype(np.uint8)) & 1 == 1


def joined_table(slices: Sequence[tuple[int, bytes]], table_bits: int, shard_bits: int) -> np.ndarray:
    """The bit table of all shards; shards without a slice are empty."""
    each = 1 << (table_bits - shard_bits)
    table = np.zeros(1 << table_bits, dtype=bool)
    for shard, raw in slices:
        table[shard * each : (shard + 1) * each] = np.unpackbits(np.frombuffer(raw, dtype=np.uint8), count=each)
    return np.packbits(table)
