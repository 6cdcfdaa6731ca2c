"""Operators on documents against brute force, on awkward rows and on empty tables."""

from __future__ import annotations

import gc
import io
import itertools
import random
import weakref
import zlib
from collections import defaultdict

import numpy as np
import pytest
from conftest_llm import AWKWARD
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from vendorium.llm import language, mixing, ngram_join, packing, sharding, token_files, tokens, toxicity, words


@pytest.fixture(scope="module")
def vocabulary():
    return tokens.read_vocabulary(tokens.default_vocabulary())


@pytest.fixture(scope="module")
def whole(vocabulary):
    tokenizer = Tokenizer.from_str(vocabulary)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def test_word_encoder_equals_whole_texts(vocabulary, whole):
    encoder, random_ = tokens.WordEncoder(vocabulary), random.Random(5)
    letters = "ab'sT,.!1é́̈　\x1c  \n\tΣİ가<|endoftext|>漢"
    for _ in range(3000):
        text = "".join(random_.choice(letters) for _ in range(random_.randint(0, 14))) + random_.choice(["", "<|endoftext|>"])
        assert tokens.ids_of(encoder.encode(text)).tolist() == whole(text)


def test_words_of_letters_need_the_model_alone(vocabulary, whole):
    """Letters beyond ASCII, capitals and marks after words do not go through the whole tokenizer, with the same ids."""
    encoder, seen = tokens.WordEncoder(vocabulary), []
    library, raw = encoder._library, encoder._library.raw
    library.raw = lambda text: seen.append(text) or raw(text)
    texts = ["Ci\u00f3nasasas, graci\u00f3.", "\u0413\u0434\u0435 \u03a3\u03af\u03c3\u03c5\u03c6\u03bf\u03a3 \u00dcber", "Reattion$$$ WORD### word(*)", "\u0130a e\u0301t\u00e9. it's"]
    assert [tokens.ids_of(encoder.encode(text)).tolist() for text in texts] == [whole(text) for text in texts]
    assert set(seen) == {",", ".", "$$$", "###", "(*)", "\u0130a", "e\u0301t\u00e9.", "it's"}


def test_forgotten_words_are_freed(vocabulary):
    """Nothing but the encoder holds its words, and a generation does not hold the ones before."""
    encoder = tokens.WordEncoder(vocabulary, 2)
    for n in range(6):
        encoder.encode(f"w{n}a w{n}b w{n}c")
    assert not encoder._young._old._old
    alive = weakref.ref(encoder._young)
    gc.disable()
    try:
        del encoder
        assert alive() is None
    finally:
        gc.enable()


@pytest.mark.parametrize("bits", [8, 16, 24, 32])
def test_ids_of_whole_bytes_are_copied_without_unpacking_bits(bits, monkeypatch):
    ids = np.random.default_rng(bits).integers(0, 2**bits, 1001, dtype=np.uint64).astype("<u4")
    flat = np.unpackbits(ids.view(np.uint8).reshape(-1, 4), axis=1, count=bits, bitorder="little")
    expected = np.packbits(flat, bitorder="little").tobytes()
    monkeypatch.setattr(np, "unpackbits", None)
    assert token_files.pack_ids(ids, bits) == expected
    assert token_files.unpack_ids(expected, len(ids), bits).tolist() == ids.tolist()


def one_by_one(lengths, capacity):
    bins, places = [], []
    for length in sorted(lengths, reverse=True):
        fitting = [(room, place) for place, room in enumerate(bins) if room >= length]
        if fitting:
            place = min(fitting)[1]
        else:
            place = len(bins)
            bins.append(capacity)
        places.append((length, capacity - bins[place]))
        bins[place] -= length
    return len(bins), sorted(places)


@pytest.mark.parametrize("seed", range(30))
def test_plan_is_best_fit_decreasing(seed):
    random_ = random.Random(seed)
    capacity = random_.choice([10, 37, 64])
    lengths = [random_.randint(1, capacity) for _ in range(random_.randint(0, 80))]
    plan = packing.best_fit_plan({n: lengths.count(n) for n in set(lengths)}, capacity)
    runs, placed = defaultdict(list), []
    for length, item, each, first, offset in plan.tolist():
        runs[length].append((item, each, first, offset))
    bins = defaultdict(int)
    for length in set(lengths):
        for item in range(lengths.count(length)):
            start, each, first, offset = max(run for run in runs[length] if run[0] <= item)
            place = (item - start) // each
            placed.append((length, offset + (item - start) % each * length))
            bins[first + place] += length
    number, expected = one_by_one(lengths, capacity)
    assert len(bins) == number and all(size <= capacity for size in bins.values())
    assert sorted(placed) == expected


def test_packing(awkward, empty, vocabulary, whole):
    rows = packing.pack_documents(awkward, vocabulary, capacity=512, ids=True)
    found = rows.collect()
    by_doc = defaultdict(int)
    for row in found:
        by_doc[row.doc_id] += row.length
    for doc, text, *_ in AWKWARD:
        assert by_doc[doc] == sum(len(whole(t)) + 1 for d, t, *_ in AWKWARD if d == doc)
    for _, pieces in itertools.groupby(sorted(found, key=lambda r: (r.sequence_id, r.offset)), key=lambda r: r.sequence_id):
        at = 0
        for piece in pieces:
            assert piece.offset == at and zlib.crc32(piece.ids) == piece.ids_crc32
            at += piece.length
        assert at <= 512
    assert packing.pack_documents(empty, vocabulary).collect() == []


def test_token_file_round_trip():
    random_ = np.random.default_rng(1)
    for bits in (1, 7, 16, 17, 32):
        docs = [(n, random_.integers(0, 2**bits, size, dtype=np.uint32)) for n, size in enumerate([1, 8191, 2, 20000, 1, 0, 8192])]
        stream = io.BytesIO()
        writer = token_files.TokenFileWriter(stream, bits)
        for n, ids in docs:
            writer.add(n, ids.astype("<u4").tobytes())
        writer.close()
        stream.size = lambda stream=stream: len(stream.getvalue())
        file = token_files.TokenFile(stream)
        assert [(n, ids.tolist()) for n, _, ids in file.documents()] == [(n, ids.tolist()) for n, ids in docs]
        flat = np.concatenate([ids for _, ids in docs])
        assert file.ids(8000, 17000).tolist() == flat[8000:17000].tolist()


def test_token_files(spark, awkward, empty, vocabulary, whole, tmp_path):
    size = tokens.vocabulary_size(vocabulary)
    files = token_files.write_token_files(awkward, f"{tmp_path}/a", vocabulary, size)
    found = sorted(map(tuple, token_files.read_token_files(files).collect()), key=lambda r: r[1])
    ordered = sorted(AWKWARD, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    start, expected = 0, []
    for doc, text, *_ in ordered:
        ids = whole(text) + [2]
        expected.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert found == expected
    none = token_files.write_token_files(empty, f"{tmp_path}/b", vocabulary, size)
    assert token_files.read_token_files(none).collect() == []


@pytest.mark.parametrize("rows", [1, 2, 3, 16, 17, 1000, 4097])
def test_permutation(rows):
    numbers = np.arange(rows)
    places = sharding.permute(numbers, rows)
    assert sorted(places.tolist()) == numbers.tolist()
    assert sharding.unpermute(places, rows).tolist() == numbers.tolist()
    assert sharding.permute(numbers, rows).tolist() == places.tolist()


def test_shards(awkward, empty):
    found = sharding.document_shards(awkward, shards=3).collect()
    assert len(found) == len(AWKWARD) and sorted((r.shard, r.slot) for r in found) == sorted((n % 3, n // 3) for n in range(len(AWKWARD)))
    again = sharding.document_shards(awkward.repartition(5, "text"), shards=3).collect()
    assert sorted(map(str, found)) == sorted(map(str, again))
    assert {(r.size, r.text_crc32) for r in found if r.doc_id in (1, 2)} == {(1, 0)}
    assert sharding.document_shards(empty).collect() == []


def test_targets(spark):
    sizes = spark.createDataFrame([("a", 100), ("b", 10), ("c", 0), (None, 400), ("B", 50)], "source string, source_size long")
    found = {r.source: r.target for r in mixing.source_targets(sizes).collect()}
    order, total = ["B", "a", "b", "c", None], 560  # code points; weights 1 2 3 1 2
    weight, size = dict(zip(order, [1, 2, 3, 1, 2], strict=True)), {"a": 100, "b": 10, "c": 0, None: 400, "B": 50}
    full: set = set()
    while True:
        level = (total - sum(3 * size[s] for s in full)) / sum(weight[s] for s in order if s not in full)
        now = {s for s in order if 3 * size[s] <= weight[s] * level} | full
        if now == full:
            break
        full = now
    assert found == pytest.approx({s: 3 * size[s] if s in full else weight[s] * level for s in order})
    assert sum(found.values()) == pytest.approx(total)


def test_mixing(awkward, empty, make_docs):
    mixed = mixing.mix_documents(awkward)
    rows = mixed.collect()
    assert len(rows) == len(AWKWARD) and all(0 <= r.copies <= 3 for r in rows)
    assert {r["size"] for r in rows if r.doc_id == 6} == {30_000}
    assert mixing.emit(mixed, ["doc_id"]).count() == sum(r.copies for r in rows)
    assert mixing.mix_documents(empty).collect() == []
    many = make_docs([(n, "w " * 10, "en", "xyz"[n % 3]) for n in range(1500)])
    for row in mixing.mix_documents(many).groupBy("source").agg(F.sum(F.col("copies") * F.col("size")).alias("t"), F.first("target").alias("g")).collect():
        assert row.t == pytest.approx(row.g, rel=0.1)


def brute_sets(rows, size):
    sets = []
    for _, text, *_ in rows:
        own = (text or "").encode().lower().split()
        sets.append({tuple(own)} if 0 < len(own) < size else {tuple(own[k : k + size]) for k in range(len(own) - size + 1)})
    return sets


def near_rows(seed):
    random_, rows = random.Random(seed), []
    for base in range(12):
        text = [f"w{random_.randint(0, 400)}" for _ in range(random_.choice([2, 5, 80, 200]))]
        for _ in range(random_.choice([1, 3, 9])):
            own = list(text)
            for _ in range(random_.choice([0, 0, 1, 1, 2, 5])):
                own[random_.randrange(len(own))] = f"v{random_.randint(0, 10_000)}"
            rows.append((len(rows), " ".join(own)))
    random_.shuffle(rows)
    return rows


@pytest.mark.parametrize(("size", "percent"), [(4, 85), (5, 80)])
def test_ngram_join(make_docs, size, percent):
    rows = near_rows(size)
    sets, ids = brute_sets(rows, size), [r[0] for r in rows]
    least = dict(zip(ids, ids, strict=True))
    links = [(a, b) for (a, x), (b, y) in itertools.combinations(zip(ids, sets, strict=True), 2) if x and 100 * len(x & y) >= percent * len(x | y)]
    for _ in ids:
        for a, b in links:
            least[a] = least[b] = min(least[a], least[b])
    found = ngram_join.similar_components(make_docs(rows), size, percent).collect()
    assert len(links) > 20
    assert {r.doc_id: r.component_id for r in found} == least
    assert {r.doc_id: r.n_shingles for r in found} == {i: len(s) for i, s in zip(ids, sets, strict=True)}


def test_ngram_join_awkward(awkward, empty):
    found = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in ngram_join.similar_components(awkward).collect())
    assert found == sorted([("1", 0, "1"), ("2", 0, "2"), ("3", 0, "3"), ("4", 7, "4"), ("4", 7, "4"), ("5", 7, "4"), ("None", 7, "None"), ("6", 1, "6"), ("7", 1, "7"), ("8", 1, "8")])
    kept = ngram_join.keep_one(awkward)
    assert kept.columns == awkward.columns and sorted(str(r.doc_id) for r in kept.collect()) == sorted(["1", "2", "3", "4", "None", "6", "7", "8"])
    assert ngram_join.similar_components(empty).collect() == [] == ngram_join.keep_one(empty).collect()


def test_word_hashes_do_not_depend_on_neighbours():
    texts = ["Ab c", None, "", "x " * 5, "ab  C\n", "é Ab c"]
    alone = [list(words.shingle_sets([text], 2))[0].tolist() for text in texts]
    assert [s.tolist() for s in words.shingle_sets(texts, 2)] == alone and alone[0] == alone[4]


def test_language(make_docs, awkward, empty):
    random_, rows = random.Random(2), []
    stems = {"aa": ["kalo", "mira", "tonu"], "bb": ["schef", "grint", "wolz"]}
    for n in range(400):
        lang = random_.choice(["aa", "bb"])
        rows.append((n, " ".join(random_.choice(stems[lang]) for _ in range(random_.randint(1, 9))), lang if n % 7 else None))
    docs = make_docs(rows)
    model = language.train(docs)
    found = {r.doc_id: r for r in language.predict_documents(docs, model).collect()}
    right = [found[n].lang_pred == lang for n, _, lang in rows if lang and found[n].held_out]
    assert len(right) > 50 and all(right) and all(0 <= r.score <= 1 for r in found.values())
    assert all(r.held_out == (zlib.crc32(str(n).encode()) % 4 == 2) for n, r in found.items())
    odd = language.predict_documents(awkward, model).collect()
    assert len(odd) == len(AWKWARD) and {r.lang_pred for r in odd if r.doc_id in (1, 2, 3, 8)} == {"und"}
    nothing = language.predict_documents(awkward, language.train(empty)).collect()
    assert {r.lang_pred for r in nothing} == {"und"}
    assert language.predict_documents(empty, model).collect() == []


def test_code_lengths_by_hand():
    text = language.normal("abracadabra abra")
    found, _ = language.windows([text])
    tree = language.ContextTree.of(*np.unique(found, return_counts=True))
    padded = b"\n\n\n" + text

    def cost(context, byte):
        after = [padded[i + len(context)] for i in range(3 - len(context), len(padded) - len(context)) if padded[i : i + len(context)] == context]
        if not after:
            return cost(context[1:], byte) if context else 8.0
        total, seen = len(after) + len(set(after)), after.count(byte)
        if seen:
            return np.log2(total / seen)
        return np.log2(total / len(set(after))) + (cost(context[1:], byte) if context else 8.0)

    tested, _ = language.windows([b"bracaz dab"])
    raw = b"\n\n\nbracaz dab"
    assert tree.cost(tested) == pytest.approx([cost(raw[i : i + 3], raw[i + 3]) for i in range(len(raw) - 3)])
    scorer = language.Scorer(language.Languages(("x",), (tree,)))
    assert scorer.bits([b"bracaz dab"])[0, 0] == pytest.approx(tree.cost(tested).sum(), rel=1e-5)


def test_toxicity(spark, make_docs, awkward, empty):
    random_, rows, marks = random.Random(3), [], []
    for n in range(1200):
        toxic = n % 5 == 0
        own = [f"w{random_.randint(0, 300)}" for _ in range(20)] + ["badword"] * toxic
        random_.shuffle(own)
        rows.append((n, " ".join(own)))
        marks.append((n, 1, int(toxic)))
    docs, labels = make_docs(rows), spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    weights = toxicity.train(docs, labels, per_class=300)
    found = toxicity.score_documents(docs, weights).collect()
    held = [r for r in found if r.held_out]
    assert len(held) > 150 and all(r.predicted == (r.doc_id % 5 == 0) for r in held) and all(0 <= r.score <= 1 for r in found)
    odd = toxicity.score_documents(awkward, weights).collect()
    assert len(odd) == len(AWKWARD) and all(r.predicted == 0 for r in odd)
    assert toxicity.score_documents(empty, weights).collect() == []
    unlearned = toxicity.train(docs, labels.limit(0))
    assert {r.score for r in toxicity.score_documents(awkward, unlearned).collect()} == {0.0}


def test_features_depend_on_the_text_alone():
    from vendorium.llm.toxicity import feature_places

    for text in ("you idiot", "idiot", "", "one two three"):
        (alone,), among = feature_places([text]), list(feature_places([text, "some words that come after"]))
        assert alone.tolist() == among[0].tolist()
