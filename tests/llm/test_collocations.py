"""Phrase mining against a plain loop; the counters against dictionaries."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from vendorium.llm import collocations, quotient_filter as qf


def brute_force(rows, least, best, inside_percent):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lower = "".join(c.lower() if c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            words = [word for word in re.split("[ \t]+", piece) if word]
            totals[lang] += len(words)
            for size in (1, 2, 3):
                counts.update((lang, *words[at : at + size]) for at in range(len(words) - size + 1))
    found = []
    for gram, a in counts.items():
        lang, *words = gram
        if len(words) == 1 or a < least:
            continue
        if len(words) == 2 and any(
            f >= least and len(other) == 4 and other[0] == lang and tuple(words) in (other[1:3], other[2:4]) and 100 * f >= inside_percent * a for other, f in counts.items()
        ):
            continue
        cuts = []
        for k in range(1, len(words)):
            left, right = counts[(lang, *words[:k])], counts[(lang, *words[k:])]
            cuts.append((1_000_000 * a * a // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        found.append((lang, -score, -a, " ".join(words).encode(), left, right))
    out = []
    for lang in {row[0] for row in found}:
        for rank, (_, score, a, phrase, left, right) in enumerate(sorted(row for row in found if row[0] == lang)[:best], start=1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def _texts(number=260):
    draw = random.Random(7)
    words = ["the", "of", "É", "É́", "new", "york", "city", "x-1", "a", "b", "\U0001f600", "the of", "Q"]
    rows = [(draw.choice(["en", "de", None, "und", ""]), "".join(draw.choice(words) + draw.choice(["  ", " ", "\t", ", ", ".", "\r\n", " ", " "]) for _ in range(draw.randrange(40)))) for _ in range(number)]
    return rows + [("en", "New York City hall. " * 30), ("en", None), (None, ""), ("fr", " ,.; "), ("en", "same row"), ("en", "same row"), ("de", "w " * 3000)]


@pytest.mark.parametrize("size", [1 << 21, 6, 0])
def test_against_a_plain_loop(spark, size):
    """With room for all words, for some, and for none."""
    rows = _texts()
    docs = spark.createDataFrame(rows, "lang string, text string").selectExpr("*", "1 AS f", "'x' AS word", "0 AS h1").repartition(4)
    found = collocations.collocations(docs, 5, 40, 50, dictionary_size=size)
    assert sorted(map(tuple, found.collect())) == brute_force(rows, 5, 40, 50)


def test_empty_and_rare(spark):
    empty = spark.createDataFrame([], "lang string, text string")
    assert collocations.collocations(empty).collect() == []
    rare = spark.createDataFrame([("en", "no phrase is often here")] * 9, "lang string, text string")
    assert collocations.collocations(rare).collect() == []
    often = spark.createDataFrame([("en", "one two")] * 10, "lang string, text string")
    assert list(map(tuple, collocations.collocations(often).collect())) == [("en", 1, "one two", 10, 10, 10, 20, 1_000_000)]


@pytest.mark.parametrize("length", [1, 2, 3])
def test_cut_texts_count_alike(monkeypatch, length):
    """Small buffers cut long texts between words without losing or repeating a phrase."""
    draw = random.Random(3)
    texts = ["".join(draw.choice(["a", "bb", "ccc" * 9]) + draw.choice([" ", "  ", ". ", "\n", " \t "]) for _ in range(400)), "z" * 500, " " * 300 + "q " * 200, "", "x"]
    batch = pa.RecordBatch.from_pydict({"lang": ["en"] * len(texts), "text": [text.encode() for text in texts]})

    def counted():
        found = Counter()
        for words, _ in collocations._buffers(iter([batch]), 0, length - 1):
            for at in range(len(words.keys) - length + 1):
                if words.piece[at] == words.piece[at + length - 1]:
                    found[tuple(words.keys[at : at + length].tolist())] += 1
        return found

    whole = counted()
    for size in (1, 7, 40, 333):
        monkeypatch.setattr(collocations, "_BUFFER", size)
        assert counted() == whole


@given(st.integers(1, 64), st.data())
@settings(max_examples=60, deadline=None)
def test_permutation_can_be_undone(bits, data):
    values = np.array(data.draw(st.lists(st.integers(0, 2**bits - 1), max_size=20)), dtype=np.uint64)
    assert (qf.restore(qf.permute(values, bits), bits) == values).all()


def test_permutation_is_one_to_one():
    assert sorted(qf.permute(np.arange(1 << 13, dtype=np.uint64), 13).tolist()) == list(range(1 << 13))


@given(st.integers(1, 64), st.integers(0, 5), st.integers(0, 2), st.data())
@settings(max_examples=80, deadline=None)
def test_filters_lose_nothing(bits, shard_bits, more, data):
    """Counts by small counters, merged by shard, equal those of a dictionary."""
    keys = data.draw(st.lists(st.tuples(st.integers(0, min(2**bits - 1, 400)), *[st.integers(0, 2) for _ in range(more)]), max_size=300))
    keys += keys[:1] * 600
    parts: dict[int, list[bytes]] = {}
    for half in (keys[::2], keys[1::2]):
        counter = qf.Counter(bits, shard_bits, limit=20)
        for at in range(0, len(half), 50):
            columns = [np.array(column, dtype=np.uint64) for column in zip(*half[at : at + 50])] or [np.empty(0, np.uint64)] * (more + 1)
            for shard, raw in counter.add(columns):
                parts.setdefault(shard, []).append(raw)
        for shard, raw in counter.filters():
            parts.setdefault(shard, []).append(raw)
    found = Counter()
    for shard, raws in parts.items():
        columns, counts = qf.merge(raws, shard)
        columns[0] = qf.restore(columns[0], bits)
        found.update(dict(zip(zip(*[c.tolist() for c in columns]), counts.tolist(), strict=True)))
    assert found == Counter(keys)


def test_bit_table_never_misses():
    bits, table_bits, shard_bits = 30, 12, 3
    values = np.random.default_rng(1).integers(0, 1 << bits, 300, dtype=np.uint64)
    permuted = np.sort(qf.permute(values, bits))
    shards = permuted >> np.uint64(bits - shard_bits)
    slices = [(int(s), qf.occupied(permuted[shards == s], bits, table_bits, shard_bits)) for s in np.unique(shards)]
    table = qf.joined_table(slices, table_bits, shard_bits)
    assert qf.probed(table, values, bits, table_bits).all()
    assert qf.probed(table, np.arange(5000, dtype=np.uint64), bits, table_bits).mean() < 0.2
