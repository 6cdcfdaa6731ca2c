"""Input that must not end a job: very long texts, JSON that is none, equal digests, repeated ids, hot ids."""

from __future__ import annotations

import json
import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from vendorium.llm import chat, language, mixing, ngram_join, sharding, token_files, tokens, toxicity, words


def _long_text(size: int) -> str:
    draw = random.Random(size)
    return "".join(draw.choice(["alpha", "Beta,", "né", "x" * 300]) + draw.choice([" ", "  ", "\n", "\x0b"]) for _ in range(size))


@pytest.fixture
def small_buffers(monkeypatch):
    """Texts of some hundred bytes count as long."""
    monkeypatch.setattr(words, "_BUFFER_BYTES", 64)


def test_shingles_of_long_texts(monkeypatch):
    texts = [_long_text(400), "one two", "y" * 3000, _long_text(900), "", "a b c d e"]
    whole = [found.tolist() for found in words.shingle_sets(texts, 4)]
    monkeypatch.setattr(words, "_BUFFER_BYTES", 64)
    assert any(words.is_long(text.encode()) for text in texts)
    assert [found.tolist() for found in words.shingle_sets(texts, 4)] == whole


def test_pieces_have_every_run_of_words_once_or_more(small_buffers):
    text = _long_text(500).encode()
    runs = lambda part: {tuple(part.split()[at : at + 3]) for at in range(len(part.split()) - 2)}
    parts = list(words.pieces(text, 2))
    assert len(parts) > 5 and set().union(*map(runs, parts)) == runs(text)


def test_features_and_scores_of_long_texts(monkeypatch):
    texts = [_long_text(700), "short one"]
    whole = [np.unique(found).tolist() for found in toxicity.feature_places(texts)]
    table = np.random.default_rng(1).normal(size=1 << toxicity.BITS).astype(np.float32)
    scores = toxicity.scores(texts, table)
    monkeypatch.setattr(words, "_BUFFER_BYTES", 64)
    assert [np.unique(found).tolist() for found in toxicity.feature_places(texts)] == whole
    assert np.allclose(toxicity.scores(texts, table), scores)


def test_code_lengths_of_long_texts(monkeypatch):
    texts = [language.normal(_long_text(600)), b"abc"]
    trees = tuple(language.ContextTree.of(*np.unique(language.windows([sample])[0], return_counts=True)) for sample in (texts[0][:500], b"the cat"))
    whole = language.Scorer(language.Languages(("a", "b"), trees)).bits(texts)
    monkeypatch.setattr(words, "_BUFFER_BYTES", 64)
    monkeypatch.setattr(language, "_PIECE", 100)
    assert np.allclose(language.Scorer(language.Languages(("a", "b"), trees)).bits(texts), whole, rtol=1e-5)


def test_tokens_of_long_texts(monkeypatch):
    encoder = tokens.WordEncoder(tokens.read_vocabulary(tokens.default_vocabulary()))
    text = _long_text(300) + "z" * 5000
    whole = encoder._raw(text)
    monkeypatch.setattr(tokens, "_PIECE", 50)
    assert encoder.encode(text) == whole
    monkeypatch.setattr(tokens, "_KNOWN_WORDS", 3)
    assert list(encoder.encode_many([text, None, "", "a, B. c!"] * 3)) == [whole, b"", b"", encoder._raw("a, B. c!")] * 3


def test_one_long_document_among_others(spark, make_docs):
    rows = [(1, "word after word " * 700_000, "en", "a"), (2, "der kurze Satz hier", "de", "b"), (3, "the short one here", "en", "b")]
    docs = make_docs(rows)
    found = {row.doc_id: row for row in language.predict_documents(docs, language.train(docs)).collect()}
    assert found.keys() == {1, 2, 3}
    sets = {row.doc_id: row.n_shingles for row in ngram_join.similar_components(docs.select("doc_id", "text")).collect()}
    assert sets == {1: 3, 2: 1, 3: 1}


def test_three_thousand_languages(spark):
    """Each with a word of its own; what is learned stays within the sample's bytes, and most are told apart."""
    rows = [(3 * n + k, f"l{n:04d}", f"w{n:04d} " * 12) for n in range(3000) for k in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(8)
    learned = language.train(docs)
    assert len(learned.names) > 2500 and sum(len(tree.symbols[0]) for tree in learned.trees) < 100_000
    few = docs.filter("doc_id % 601 = 0")
    found = {row.doc_id: row.lang_pred for row in language.predict_documents(few, learned).collect()}
    right = sum(found[doc] == lang for doc, lang, _ in rows if doc in found and lang in learned.names)
    assert len(found) >= 8 and right >= 0.9 * sum(lang in learned.names for doc, lang, _ in rows if doc in found)


def test_long_texts_make_the_sample_smaller(spark, monkeypatch):
    monkeypatch.setattr(language, "SAMPLE_BYTES", 4000)
    docs = spark.createDataFrame([(n, "en", f"word{n} " * 100) for n in range(400)], "doc_id long, lang string, text string")
    few = language.train(docs)
    monkeypatch.undo()
    assert few.names == ("en",) and len(few.trees[0].symbols[-1]) < len(language.train(docs).trees[0].symbols[-1]) / 4


@pytest.mark.parametrize("text", ["NaN", "[1, Infinity]", '{"a": -Infinity}', "1e999", '"\\ud800"', '{"\\udfff": 1}', "[" * 100_000, "{", ""])
def test_json_that_cannot_be_written_again(text):
    with pytest.raises(ValueError):
        chat.parsed(text)


def test_calls_with_such_arguments_come_out_with_an_error(spark):
    texts = ['{"text": NaN}', '{"text": "\\ud800"}', "[" * 5000 + "]" * 5000, '{"text": "x", "turn": 1}', '{"text": "' + "y" * 2_000_000 + '", "turn": 1}']
    calls = spark.createDataFrame([(n, n, str(n), "reply", text) for n, text in enumerate(texts)], "conv_id long, turn long, call_id string, name string, arguments string")
    results = spark.createDataFrame([], "conv_id long, turn long, call_id string, content string")
    needs = spark.createDataFrame([], "conv_id long, call_id string, needed string")
    rows = {row.conv_id: row for row in chat.link_calls(calls, results, needs, chat.REPLY_SCHEMA).collect()}
    assert [rows[n].error is None for n in range(5)] == [False, False, False, True, True]
    assert all(json.loads(row.json)["id"] == str(n) for n, row in rows.items())


def test_empty_conversations(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.link_conversations(empty).collect() == []


def test_equal_digests_of_different_sets(spark, make_docs):
    def clashing(values: bytes, seed: int) -> int:
        return 7 if seed == 0 else ngram_join.digest(values, seed)

    rows = [(1, "a b c d e f"), (2, "g h i j k l"), (3, "a b c d e f"), (4, "m n o p"), (5, None)]
    found = ngram_join.similar_components(make_docs(rows).select("doc_id", "text"), number=clashing)
    assert {row.doc_id: row.component_id for row in found.collect()} == {1: 1, 2: 2, 3: 1, 4: 4, 5: 5}


def test_a_common_ngram_links_nothing_by_itself(spark, make_docs):
    """A third of all rows share one shingle, and some of them nearly everything."""
    same = "in the year of our lord"
    rows = [(n, f"{same} " + " ".join(f"w{n}x{k}" for k in range(30))) for n in range(200)]
    rows += [(1000 + n, f"{same} " + " ".join(f"w7x{k}" for k in range(30)) + " end" * (n % 2)) for n in range(50)]
    found = {row.doc_id: row.component_id for row in ngram_join.similar_components(make_docs(rows).select("doc_id", "text")).collect()}
    assert all(found[n] == n for n in range(200)) and all(found[1000 + n] == 7 for n in range(50))


def _taken(mixed):
    sums, targets = defaultdict(int), {}
    for row in mixed.collect():
        sums[row.source] += row.copies * row.size
        targets[row.source] = row.target
    return {source: (sums[source], targets[source]) for source in targets}


def test_sources_come_near_their_targets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = _taken(mixing.mix_documents(docs))
    assert len(found) > 10 and all(abs(taken - target) <= 0.05 * target for taken, target in found.values())


def test_a_dominant_document_and_repeated_ids(spark, make_docs):
    big, small = " ".join(["w"] * 6300), "w w w w w w w w w w"
    rows = [(1, big, "en", "a")] + [(n, small, "en", "a") for n in range(2, 200)]
    rows += [(9000, small, "en", "b")] * 300 + [(None, small, "en", "b")] * 100 + [(n, small, "en", "c") for n in range(300, 500)]
    docs = make_docs(rows)
    mixed = mixing.mix_documents(docs)
    found = _taken(mixed)
    assert abs(found["b"][0] - found["b"][1]) <= 0.05 * found["b"][1] and abs(found["c"][0] - found["c"][1]) <= 0.05 * found["c"][1]
    assert abs(found["a"][0] - found["a"][1]) <= max(6300 / 2, 0.05 * found["a"][1]) + 200
    assert mixed.count() == len(rows) and mixed.agg(F.max("copies")).first()[0] <= 3
    assert sorted(map(str, mixed.collect())) == sorted(map(str, mixing.mix_documents(docs.repartition(3)).collect()))


def test_rows_under_one_id_go_to_several_token_files(spark, tmp_path):
    vocabulary = tokens.read_vocabulary(tokens.default_vocabulary())
    rows = [(7, f"text {n % 5}") if n % 3 == 0 else (n, "other") for n in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        files = token_files.write_token_files(docs, str(tmp_path / "files"), vocabulary, tokens.vocabulary_size(vocabulary))
        counts = [row.n_docs for row in files.collect()]
        assert sum(counts) == 3000 and max(counts) <= 2 * 3000 / 8
        found = token_files.read_token_files(files).orderBy("start").collect()
        assert [row.doc_id for row in found] == sorted(row[0] for row in rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_unknown_file_systems_are_refused_before_any_work(spark):
    docs = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    with pytest.raises(Exception, match="nosuch"):
        token_files.write_token_files(docs, "nosuch://bucket/folder", "not even a vocabulary", 10)


def _plain_ftrl(rows, rates, shift):
    """FTRL-proximal, one number after the other."""
    z, n = defaultdict(float), defaultdict(float)

    def weight(place):
        least = 0.0 if place == 0 else rates.l1
        if abs(z[place]) <= least and place:
            return 0.0
        return -(z[place] - math.copysign(least, z[place])) / ((rates.beta + math.sqrt(n[place])) / rates.alpha + rates.l2)

    for places, label in rows:
        now = {place: weight(place) for place in places}
        chance = 1 / (1 + math.exp(-max(-35.0, min(35.0, sum(now.values())))))
        gradient = chance - label
        for place in places:
            step = (math.sqrt(n[place] + gradient**2) - math.sqrt(n[place])) / rates.alpha
            z[place] += gradient - step * now[place]
            n[place] += gradient**2
    found = {place: weight(place) for place in list(z) if place and abs(z[place]) > rates.l1}
    return found | {0: weight(0) + shift}


def test_learning_equals_a_plain_loop():
    draw = random.Random(2)
    rows = []
    for _ in range(400):
        label = int(draw.random() < 0.3)
        places = {0} | {draw.randrange(1, 60) for _ in range(8)} | ({99} if label and draw.random() < 0.9 else set())
        rows.append((np.array(sorted(places), dtype=np.int32), label))
    rates = toxicity.Rates(l1=1.0)
    learned = toxicity.learn(iter(rows), rates, 0.25)
    plain = _plain_ftrl([(places.tolist(), label) for places, label in rows], rates, 0.25)
    assert dict(zip(learned.places.tolist(), learned.values.tolist(), strict=True)) == pytest.approx(plain, rel=1e-5)
    assert len(plain) > 10


def _plain_feistel(number: int, rows: int, seed: int) -> int:
    """One number through the network, again and again until it is below `rows`."""
    keys = [int(key) for key in np.random.default_rng(seed).integers(0, 2**64, sharding.ROUNDS, dtype=np.uint64)]
    half = max(1, (max(1, rows - 1).bit_length() + 1) // 2)
    mask, all64 = (1 << half) - 1, (1 << 64) - 1

    def mixed(value: int) -> int:
        value = ((value ^ value >> 30) * 0xBF58476D1CE4E5B9) & all64
        value = ((value ^ value >> 27) * 0x94D049BB133111EB) & all64
        return value ^ value >> 31

    while True:
        left, right = number >> half, number & mask
        for key in keys:
            left, right = right, left ^ (mixed((right + key) & all64) & mask)
        number = left << half | right
        if number < rows:
            return number


def test_shards_equal_a_plain_loop(spark):
    """Shard and slot of every row, also where a third of the rows are alike."""
    import zlib

    rows = [(5, "same")] * 300 + [(n % 400, f"text {n}") for n in range(600)] + [(None, None)] * 3
    keys = sorted((doc is not None, doc or 0, len((text or "").encode()) + 1, zlib.crc32((text or "").encode())) for doc, text in rows)
    wanted = []
    for number, (known, doc, size, crc) in enumerate(keys):
        place = _plain_feistel(number, len(rows), sharding.SEED)
        wanted.append((doc if known else None, size, crc, "rows", place % 16, place // 16, None))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert sorted(map(tuple, sharding.document_shards(docs).collect()), key=repr) == sorted(wanted, key=repr)
