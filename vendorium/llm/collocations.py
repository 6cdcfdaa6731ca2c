"""Phrases whose words go together, mined from exact counts in counting quotient filters.

Words of a language are counted first. Pairs are counted only of words that are frequent enough, triples only of pairs
that may be: a phrase is never more frequent than its parts, so nothing is lost.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from vendorium.llm import quotient_filter as qf
from vendorium.llm.scratch import Scratch
from vendorium.llm.shipping import ship
from vendorium.operators.numbering import number_rows

LEAST = 10  # occurrences of a phrase at least
BEST = 2000  # phrases returned for each language
INSIDE_PERCENT = 50  # share of a phrase's occurrences inside a longer one from which it is dropped
UNKNOWN = "und"

DICTIONARY = 1 << 21  # words with a short number at most: 16 MB sent to each worker; others are counted by 64-bit numbers
TABLE_BITS = 27  # size of the bit table of frequent pairs at most: 16 MB
SHARD_WORDS = 1 << 20  # words of the corpus for each shard of the counters, about
MOST_SHARD_BITS = 20
_BUFFER = 1 << 21  # bytes of text handled at a time; longer texts are cut between words
_TRIES = 8

_BREAKS, _SPACES = b".,;:!?\n\x0b\x0c\r", b" \t"
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[list(_SPACES)] = 1
_KIND[list(_BREAKS)] = 2
_SEPARATOR = re.compile(b"[" + re.escape(_SPACES + _BREAKS) + b"]")
_NEXT_WORD = re.compile(b"[" + re.escape(_SPACES + _BREAKS) + b"]*+[^" + re.escape(_SPACES + _BREAKS) + b"]++")


def _mix(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


def _last_words(text: bytes, start: int, end: int, number: int) -> int:
    """Where the last `number` words of text[start:end] begin; not after `start` if there are no more words than that."""
    for _ in range(number):
        end = start + len(text[start:end].rstrip(_SPACES + _BREAKS))
        end = max(text.rfind(separator, start, end) for separator in map(bytes, zip(_SPACES + _BREAKS))) + 1
        if end <= start:
            break
    return end


def _pieces(text: bytes, overlap: int) -> Iterator[bytes]:
    """A text in pieces of about `_BUFFER` bytes, cut between words. Each begins with the last `overlap` words of the one
    before, so a phrase of one word more is in exactly one piece. Only words as long as that make longer pieces."""
    start = 0
    while len(text) - start > _BUFFER and (cut := _SEPARATOR.search(text, start + _BUFFER)):
        end = cut.start()
        while (back := _last_words(text, start, end, overlap)) <= start and (more := _NEXT_WORD.match(text, end)):
            end = more.end()
        if back <= start:
            break
        yield text[start:end]
        start = back
    yield text[start:]


class Words:
    """The words of some texts as 64-bit numbers of (language, word), with the piece of text that each stands in."""

    def __init__(self, texts: Sequence[bytes], languages: Sequence[int], seed: int):
        # A break after each text keeps phrases inside it. Only A-Z change: `lower` of bytes is ASCII.
        self.buffer = np.frombuffer(b"\n".join(texts).lower() + b"\n", dtype=np.uint8)
        kinds = _KIND[self.buffer]
        edges = np.flatnonzero(np.diff((kinds == 0).view(np.int8), prepend=0))
        self.starts, self.ends = edges[0::2], edges[1::2]
        breaks = np.cumsum(kinds == 2, dtype=np.int32)
        self.piece = breaks[self.starts]
        random = np.random.default_rng(seed)
        values = random.integers(0, 2**64, 256, dtype=np.uint64)
        base = int(random.integers(0, 2**63)) * 2 + 1
        sums = np.zeros(len(self.buffer) + 1, dtype=np.uint64)
        np.cumsum(values[self.buffer] * _powers(base, len(self.buffer)), out=sums[1:], dtype=np.uint64)
        inverse = _powers(pow(base, -1, 2**64), len(self.buffer))
        words = (sums[self.ends] - sums[self.starts]) * inverse[self.starts]
        text_starts = np.cumsum([0] + [len(text) + 1 for text in texts])
        per_text = np.diff(np.searchsorted(self.starts, text_starts))
        self.keys = _mix(words + np.repeat(np.array(languages, dtype=np.uint64), per_text))
        self.text = np.repeat(np.arange(len(texts)), per_text)

    def word(self, at: int) -> bytes:
        return self.buffer[self.starts[at] : self.ends[at]].tobytes()


_kept_powers: dict[int, np.ndarray] = {}


def _powers(base: int, size: int) -> np.ndarray:
    """Powers of an odd number; those for one buffer are kept, more are made for a single longer word."""
    known = _kept_powers.get(base)
    if known is None or len(known) < size:
        factors = np.full(max(size, 2 * _BUFFER), base, dtype=np.uint64)
        factors[0] = 1
        known = np.cumprod(factors, dtype=np.uint64)
        if size <= 2 * _BUFFER:
            _kept_powers[base] = known
    return known[:size]


def _language_number(language: str, seed: int) -> int:
    return int.from_bytes(hashlib.blake2b(language.encode("utf-8", "surrogatepass"), digest_size=8, salt=seed.to_bytes(8, "little")).digest(), "little")


def _buffers(batches: Iterator[pa.RecordBatch], seed: int, overlap: int) -> Iterator[tuple[Words, list[str]]]:
    """Words of the rows (language, text bytes), some texts at a time, with the language of each text."""
    numbers: dict[str, int] = {}
    texts: list[bytes] = []
    languages: list[str] = []
    size = 0
    for batch in batches:
        for language, text in zip(batch.column(0), batch.column(1), strict=True):
            name = language.as_py()
            if name not in numbers:
                numbers = numbers if len(numbers) < 10_000 else {}
                numbers[name] = _language_number(name, seed)
            for piece in _pieces(text.as_py(), overlap):
                if texts and size + len(piece) > _BUFFER:
                    yield Words(texts, [numbers.get(one) or _language_number(one, seed) for one in languages], seed), languages
                    texts, languages, size = [], [], 0
                texts.append(piece)
                languages.append(name)
                size += len(piece) + 1
    if texts:
        yield Words(texts, [numbers.get(one) or _language_number(one, seed) for one in languages], seed), languages


@dataclass(frozen=True)
class Corpus:
    """Texts with the counts of all their words, and the seed under which no two words that matter share a number."""

    texts: DataFrame  # lang, text
    words: DataFrame  # key, lang, word, f
    seed: int
    total: int

    @property
    def shard_bits(self) -> int:
        return min(MOST_SHARD_BITS, max(0, (self.total // SHARD_WORDS).bit_length()))


def count_words(docs: DataFrame, scratch: Scratch, least: int = LEAST) -> Corpus:
    """Every word of every language with its number of occurrences.

    A word's number is a 64-bit hash of language and word. All words are held against each other: if two share a number
    and together reach `least`, another seed is taken, so that the numbers stand for the words without loss.
    """
    ship(docs.sparkSession)
    language = F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang")
    texts = docs.select(language, F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))
    for seed in range(_TRIES):

        def count(batches: Iterator[pa.RecordBatch], seed: int = seed) -> Iterator[pa.RecordBatch]:
            for words, languages in _buffers(batches, seed, 0):
                keys, first, number = np.unique(words.keys, return_index=True, return_counts=True)
                of = pa.array(languages, pa.string()).take(pa.array(words.text[first]))
                forms = pa.array([words.word(at) for at in first.tolist()], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), of, forms, pa.array(number)], names=["key", "lang", "word", "f"])

        counted = texts.mapInArrow(count, "key long, lang string, word binary, f long")
        counted = counted.groupBy("key", "lang", "word").agg(F.sum("f").alias("f"))
        counted = scratch.write(counted.withColumn("word", F.col("word").cast("string")), "collocation-words")
        shared = counted.groupBy("key").agg(F.count("*").alias("words"), F.sum("f").alias("f"))
        if shared.filter((F.col("words") > 1) & (F.col("f") >= least)).isEmpty():
            return Corpus(texts, counted, seed, counted.agg(F.sum("f")).first()[0] or 0)
    raise RuntimeError(f"words share 64-bit numbers under each of {_TRIES} seeds")


@dataclass(frozen=True)
class Dictionary:
    """Short numbers of words: the place of a word's 64-bit number among these, sorted. `whole` if no frequent word is
    left out; otherwise phrases with other words are counted by 64-bit numbers."""

    keys: np.ndarray
    whole: bool

    @property
    def bits(self) -> int:
        return max(1, (len(self.keys) - 1).bit_length())

    def places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.keys):
            return np.zeros(len(keys), dtype=np.uint64), np.zeros(len(keys), dtype=bool)
        place = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return place.astype(np.uint64), self.keys[place] == keys


def make_dictionary(corpus: Corpus, least: int = LEAST, most: int = DICTIONARY) -> Dictionary:
    """The words with at least `least` occurrences, or with least times the smallest power of two that leaves `most`."""
    steps = [least << k for k in range(62 - least.bit_length())]
    found = corpus.words.agg(*[F.count_if(F.col("f") >= step).alias(f"s{step}") for step in steps]).first()
    step = next((step for step, number in zip(steps, found, strict=True) if number <= most), None)
    if step is None:
        return Dictionary(np.empty(0, np.uint64), not found[0])
    keys = corpus.words.filter(F.col("f") >= step).select("key").toPandas()["key"].to_numpy(np.int64)  # `most` numbers at most
    return Dictionary(np.sort(keys.view(np.uint64)), step == least)


@dataclass(frozen=True)
class PairTable:
    """Which pairs of short numbers may be frequent."""

    bits: np.ndarray
    size: int


def _phrases(words: Words, dictionary: Dictionary, length: int, pairs: PairTable | None) -> tuple[np.ndarray, qf.Keys]:
    """Phrases of `length` words that may be frequent: as packed short numbers, and as columns of 64-bit numbers."""
    number = len(words.keys) - length + 1
    if number <= 0:
        return np.empty(0, np.uint64), [np.empty(0, np.uint64)] * length
    place, known = dictionary.places(words.keys)
    inside = words.piece[:number] == words.piece[length - 1 :]
    short = known[:number].copy()
    for ahead in range(1, length):
        short &= known[ahead : ahead + number]
    width = np.uint64(dictionary.bits)
    if pairs is not None:
        both = known[:-1] & known[1:]
        may = ~both
        may[both] = qf.probed(pairs.bits, (place[:-1][both] << width) | place[1:][both], 2 * dictionary.bits, pairs.size)
        for ahead in range(length - 1):
            inside &= may[ahead : ahead + number]
    at = np.flatnonzero(inside & short)
    packed = place[at]
    for ahead in range(1, length):
        packed = (packed << width) | place[at + ahead]
    other = np.empty(0, np.int64) if dictionary.whole else np.flatnonzero(inside & ~short)
    return packed, [words.keys[other + ahead] for ahead in range(length)]


def count_phrases(
    corpus: Corpus, dictionary: Dictionary, length: int, scratch: Scratch, least: int = LEAST, pairs: PairTable | None = None, make_table: bool = False
) -> tuple[DataFrame, PairTable | None]:
    """(h1, ..., a) of all phrases of `length` words with a >= least; h are the words' 64-bit numbers.

    Each task counts in filters, one for each range of permuted phrases. Ranges are merged on the reducers: a phrase
    that is everywhere is one entry a task, and permuted phrases spread evenly, so no range is large. With `make_table`
    also a bit table of the frequent phrases, of a size that is known beforehand.
    """
    seed, width = corpus.seed, dictionary.bits
    short_bits, shard_bits = length * width, min(corpus.shard_bits, length * width)
    table_bits = min(TABLE_BITS, short_bits, max(shard_bits + 3, corpus.total.bit_length() - 3))
    names = [f"h{n + 1}" for n in range(length)]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        short, long = qf.Counter(short_bits, shard_bits), qf.Counter(64, shard_bits)

        def rows(filters: Iterator[tuple[int, bytes]], whole: bool) -> Iterator[pa.RecordBatch]:
            for shard, raw in filters:
                yield pa.RecordBatch.from_pydict({"short": [whole], "shard": [shard], "filter": [raw]}, schema=fragment)

        fragment = pa.schema([("short", pa.bool_()), ("shard", pa.int64()), ("filter", pa.binary())])
        for words, _ in _buffers(batches, seed, length - 1):
            packed, columns = _phrases(words, dictionary, length, pairs)
            yield from rows(short.add([packed]), True)
            yield from rows(long.add(columns), False)
        yield from rows(short.filters(), True)
        yield from rows(long.filters(), False)

    def merge(fragments: pa.Table) -> pa.Table:
        whole, shard = fragments.column("short")[0].as_py(), fragments.column("shard")[0].as_py()
        keys, counts = qf.merge((raw.as_py() for raw in fragments.column("filter")), shard)
        often = counts >= least
        keys, counts = [column[often] for column in keys], counts[often]
        slices: list[bytes | None] = [None] * len(counts)
        if whole:
            table = qf.occupied(keys[0], short_bits, table_bits, shard_bits) if make_table and len(counts) else None
            packed, mask = qf.restore(keys[0], short_bits), np.uint64((1 << width) - 1)
            keys = [dictionary.keys[((packed >> np.uint64(width * (length - 1 - n))) & mask).astype(np.int64)] for n in range(length)]
        else:
            table, keys = None, [qf.restore(keys[0], 64), *keys[1:]]
        columns = {name: column.view(np.int64) for name, column in zip(names, keys, strict=True)} | {"a": counts}
        arrays = {name: pa.array(np.append(column, 0) if table else column) for name, column in columns.items()}
        slices += [table] if table else []
        return pa.table({"shard": pa.array(np.full(len(slices), shard)), **arrays, "table": pa.array(slices, pa.binary())})

    schema = ", ".join(["shard long", *[f"{name} long" for name in names], "a long", "table binary"])
    fragments = corpus.texts.mapInArrow(count, "short boolean, shard long, filter binary")
    merged = scratch.write(fragments.groupBy("short", "shard").applyInArrow(merge, schema), f"collocation-phrases-{length}")
    found = merged.filter("table IS NULL").select(*names, "a")
    if not make_table:
        return found, None
    slices = [(row.shard, bytes(row.table)) for row in merged.filter("table IS NOT NULL").select("shard", "table").collect()]  # 2**table_bits bits
    return found, PairTable(qf.joined_table(slices, table_bits, shard_bits), table_bits)


def _score(left: str, right: str) -> str:
    wide = [f"CAST({name} AS DECIMAL(38,0))" for name in ("a", "a", left, right)]
    return f"(1000000 * {wide[0]} * {wide[1]}) div ({wide[2]} * {wide[3]})"


def collocations(docs: DataFrame, least: int = LEAST, best: int = BEST, inside_percent: int = INSIDE_PERCENT, dictionary_size: int = DICTIONARY) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of the best phrases of two and three words in each language.

    Texts are lower-cased in A-Z, cut at `.,;:!?` and line ends, and into words at spaces and tabs; phrases do not cross
    cuts. Null texts are empty, a null language is `und`. A phrase's score is that of its worst cut; phrases found
    mostly inside a longer candidate are dropped. Repeated rows count each time. An empty table gives no rows.
    Counts are exact for every phrase with `least` occurrences; scores are computed in 38-digit decimals.
    """
    scratch = Scratch(docs.sparkSession)
    corpus = count_words(docs.select("lang", "text"), scratch, least)
    dictionary = make_dictionary(corpus, least, dictionary_size)
    pairs, table = count_phrases(corpus, dictionary, 2, scratch, least, make_table=True)
    triples, _ = count_phrases(corpus, dictionary, 3, scratch, least, pairs=table)

    frequent = corpus.words.filter(F.col("f") >= least)
    word = [frequent.select(F.col("key").alias(f"h{n}"), F.col("lang").alias(f"lang{n}"), F.col("word").alias(f"w{n}"), F.col("f").alias(f"f{n}")) for n in (1, 2, 3)]
    inside = triples.select(F.explode(F.array(F.struct("h1", "h2"), F.struct(F.col("h2").alias("h1"), F.col("h3").alias("h2")))).alias("part"), "a")
    inside = inside.groupBy("part.h1", "part.h2").agg(F.max("a").alias("longer"))
    kept = pairs.join(inside, ["h1", "h2"], "left").filter(f"longer IS NULL OR 100 * CAST(longer AS DECIMAL(38,0)) < {inside_percent} * CAST(a AS DECIMAL(38,0))")
    two = kept.join(word[0], "h1").join(word[1], "h2")
    two = two.select(F.col("lang1").alias("lang"), F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", F.col("f1").alias("l"), F.col("f2").alias("r"), F.expr(_score("f1", "f2")).alias("score"))

    first, last = pairs.select("h1", "h2", F.col("a").alias("f12")), pairs.select(F.col("h1").alias("h2"), F.col("h2").alias("h3"), F.col("a").alias("f23"))
    three = triples.join(first, ["h1", "h2"]).join(last, ["h2", "h3"]).join(word[0], "h1").join(word[1], "h2").join(word[2], "h3")
    three = three.withColumn("s1", F.expr(_score("f1", "f23"))).withColumn("s2", F.expr(_score("f12", "f3")))
    early = F.col("s1") <= F.col("s2")
    three = three.select(
        F.col("lang1").alias("lang"), F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a",
        F.when(early, F.col("f1")).otherwise(F.col("f12")).alias("l"), F.when(early, F.col("f23")).otherwise(F.col("f3")).alias("r"),
        F.least("s1", "s2").alias("score"),
    )

    totals = corpus.words.groupBy("lang").agg(F.sum("f").alias("n"))
    # Numbered by ranges of the whole order, so that a language with most of the phrases is many tasks.
    numbered = number_rows(two.unionByName(three), "place", ("lang", F.desc("score"), F.desc("a"), "phrase"))
    first_places = numbered.groupBy("lang").agg(F.min("place").alias("first"))
    ranked = numbered.join(first_places, "lang").withColumn("rank", F.col("place") - F.col("first") + 1).filter(F.col("rank") <= best)
    longs = [F.col(name).cast("long").alias(name) for name in ("a", "l", "r", "n", "score")]
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", *longs)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE_SQL = f"""
WITH pieces AS (
    SELECT coalesce(lang, '{UNKNOWN}') AS lang,
        unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents),
lists AS (
    SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda w: w <> '') AS words FROM pieces),
grams AS (
    SELECT lang, k, unnest(list_transform(range(1, len(words) - k + 2), lambda i: array_to_string(words[i:i + k - 1], ' '))) AS phrase
    FROM lists, (SELECT unnest([1, 2, 3]) AS k) WHERE len(words) >= k),
counts AS (SELECT lang, k, phrase, count(*) AS f, string_split(phrase, ' ') AS words FROM grams GROUP BY ALL),
totals AS (SELECT lang, sum(f) AS n FROM counts WHERE k = 1 GROUP BY lang),
candidates AS (SELECT * FROM counts WHERE k > 1 AND f >= {LEAST}),
cuts AS (
    SELECT c.lang, c.k, c.phrase, c.f AS a, c.words, l.k AS cut, l.f AS l, r.f AS r,
        1000000 * c.f::HUGEINT * c.f // (l.f::HUGEINT * r.f) AS score
    FROM candidates c
    JOIN counts l ON l.lang = c.lang AND l.k < c.k AND l.phrase = array_to_string(c.words[1:l.k], ' ')
    JOIN counts r ON r.lang = c.lang AND r.k = c.k - l.k AND r.phrase = array_to_string(c.words[l.k + 1:], ' ')),
worst AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
longer AS (
    SELECT lang, part, max(f) AS f FROM (
        SELECT lang, f, unnest([array_to_string(words[1:2], ' '), array_to_string(words[2:3], ' ')]) AS part FROM candidates WHERE k = 3)
    GROUP BY lang, part),
kept AS (
    SELECT w.* FROM worst w LEFT JOIN longer o ON o.lang = w.lang AND o.part = w.phrase AND w.k = 2
    WHERE o.f IS NULL OR 100 * o.f < {INSIDE_PERCENT} * w.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score
FROM kept JOIN totals USING (lang)
QUALIFY rank <= {BEST}
"""
