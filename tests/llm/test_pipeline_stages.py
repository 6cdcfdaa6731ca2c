"""The pipeline on awkward rows, with clashing columns, and as registered."""

from __future__ import annotations

from collections import Counter, defaultdict

import duckdb
import pyarrow as pa
import pytest
from conftest_llm import AWKWARD
from pyspark import SparkContext
from tokenizers import Tokenizer

import corpus_pipeline
from vendorium.llm import language, mixing, ngram_join, tokens, toxicity, words


@pytest.fixture(scope="module")
def folder(spark, awkward, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    awkward.repartition(2).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(4, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_stages_keep_columns(spark, awkward, empty, folder):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, awkward, folder).columns == awkward.columns, name
        assert stage(spark, empty, folder).collect() == [], name


def test_decisions(spark, awkward, folder):
    stages = dict(corpus_pipeline.STAGES)
    assert stages["toxicity"](spark, awkward, folder).count() == len(AWKWARD)
    assert {r.doc_id for r in stages["language"](spark, awkward, folder).collect()} == {4, 5, 6, 7, None}
    assert sorted(str(r.doc_id) for r in stages["near_duplicates"](spark, awkward, folder).collect()) == sorted(["1", "2", "3", "4", "None", "6", "7", "8"])


def test_other_work_does_not_hold_remembered_words():
    """A worker that packed before, and now compares texts, has let go of the words it remembered for packing."""
    tokens.encoder(tokens.read_vocabulary(tokens.default_vocabulary())).encode("some words")
    texts = pa.RecordBatch.from_pydict({"text": ["one two three four five six"]})
    assert len(list(ngram_join._each_class(iter([texts]), ngram_join.Sets(5)))) == 1
    assert tokens.encoder.cache_info().currsize == 0


def test_pipeline_remembers_fewer_words_with_the_same_ids():
    """So many words are remembered as are asked for, and ids do not depend on it."""
    vocabulary = tokens.read_vocabulary(tokens.default_vocabulary())
    texts = [f"word{n} and more words {n}" for n in range(300)] * 2
    few, many = tokens.WordEncoder(vocabulary, 5), tokens.WordEncoder(vocabulary)
    assert [few.encode(text) for text in texts] == [many.encode(text) for text in texts]
    assert len(few._young) + len(few._old) < 30 < len(many._young)


def test_packing_has_one_python_step_a_task(spark, awkward, folder, monkeypatch):
    """Texts are encoded, cut and numbered in one step before the items are written, and placed in another one after it."""
    steps, plain = [], type(awkward).mapInArrow
    monkeypatch.setattr(type(awkward), "mapInArrow", lambda self, *given, **named: steps.append(self) or plain(self, *given, **named))
    rows = dict(corpus_pipeline.STAGES)["packing"](spark, awkward, folder).collect()
    assert len(steps) == 2 and sum(row.piece == 0 for row in rows) == len(AWKWARD)


def test_languages_are_learned_without_rows_from_python(spark, sf_dir, monkeypatch):
    """Rows that Python hands over as an RDD start workers of another kind on every executor, beside the others."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = language.train(docs).names
    monkeypatch.setattr(SparkContext, "parallelize", None)
    assert names and language.train(docs).names == names


def _near_copies(rows) -> set[int]:
    """The smallest doc_id of each group, by comparing all pairs of five-word shingle sets."""
    sets = {row.doc_id: set(found.tolist()) for row, found in zip(rows, words.shingle_sets([row.text for row in rows], 5), strict=True)}
    group = {doc: doc for doc in sets}

    def least(doc):
        while group[doc] != doc:
            doc = group[doc]
        return doc

    docs = sorted(sets)
    for at, one in enumerate(docs):
        for other in docs[at + 1 :]:
            shared = len(sets[one] & sets[other])
            if shared and 100 * shared >= 80 * len(sets[one] | sets[other]):
                low, high = sorted((least(one), least(other)))
                group[high] = low
    return {doc for doc in docs if least(doc) == doc}


def test_each_stage_against_a_plain_form(spark, sf_dir, tmp_path):
    """Every stage on all that the one before kept: each decision made again on the driver, document by document."""
    stages, columns = dict(corpus_pipeline.STAGES), ["doc_id", "text", "lang", "source", "n_chars"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")

    def next_docs(name):
        docs_path = f"{tmp_path}/{name}"
        stages[name](spark, docs, sf_dir).write.parquet(docs_path)
        return spark.read.parquet(docs_path)

    before = docs.collect()
    weights = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    docs = next_docs("toxicity")
    kept = toxicity.scores([row.text for row in before], weights.dense()) < 0.5
    assert sorted(map(repr, docs.collect())) == sorted(repr(row) for row, keep in zip(before, kept, strict=True) if keep)

    before, found = docs.collect(), language.train(docs)
    docs = next_docs("language")
    told = language.Scorer(found).predict([row.text for row in before])
    keep = (told["lang_pred"] != "und") & (told["bits_per_byte"] < 8)
    assert sorted(map(repr, docs.collect())) == sorted(repr(row) for row, one in zip(before, keep, strict=True) if one)

    before = docs.collect()
    docs = next_docs("near_duplicates")
    assert len({row.doc_id for row in before}) == len(before)
    chosen = _near_copies(before)
    assert sorted(map(repr, docs.collect())) == sorted(repr(row) for row in before if row.doc_id in chosen) and len(chosen) < len(before)

    database = duckdb.connect()
    database.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/near_duplicates/*.parquet'")
    wanted = {doc: taken // size for doc, size, taken in database.execute(f"SELECT doc_id, size, taken FROM ({mixing.ORACLE_SQL})").fetchall() if size}
    docs = next_docs("mixing")
    times = Counter(row.doc_id for row in docs.collect())
    assert docs.columns == columns and {doc: times[doc] for doc in wanted} == wanted

    encoder = Tokenizer.from_str(tokens.read_vocabulary(tokens.default_vocabulary()))
    pieces = Counter()
    for row in docs.collect():
        size = len(encoder.encode(row.text or "", add_special_tokens=False).ids) + 1
        pieces.update((row.doc_id, at, min(4096, size - at)) for at in range(0, size, 4096))
    packed = stages["packing"](spark, docs, sf_dir).collect()
    assert Counter((row.doc_id, row.start, row.length) for row in packed) == pieces


def test_run(spark, sf_dir):
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    ends = defaultdict(int)
    for row in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert row.offset == ends[row.sequence_id]
        ends[row.sequence_id] += row.length
    assert rows and max(ends.values()) <= 4096
