"""Phrases whose words belong together, mined from one structure: a stripe of next-word counts for every prefix."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from sievepoint.llm.text import once, whole_text
from sievepoint.operators.lookup import lookup_join
from sievepoint.runtime import materialize

BREAKS = ".,;:!?\n\x0b\x0c\r"  # a phrase does not reach over one of these
BLANKS = " \t"
# Bytes of text counted at a time. Chunks end where pieces do, so a text of any length takes bounded memory.
CHUNK = 2 << 20
# Texts handed to a counting task at a time. With the session's default of 10,000 the texts alone take a tenth of a small executor.
TEXTS_AT_ONCE = "2000"
# Bits of a phrase's hash by which it is counted before it is counted by its words, and of the sieve of frequent hashes:
# 2^20 long integers at most, however many phrases there are.
BUCKET_BITS, SIEVE_BITS = 40, 26
STRIPES = "lang string, prefix string, stripe array<struct<next: string, n: bigint, h: bigint>>"

_KIND = np.zeros(256, np.uint8)
_KIND[[ord(c) for c in BLANKS]] = 1
_KIND[[ord(c) for c in BREAKS]] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX
    return h ^ (h >> np.uint64(29))


def _hashes(strings: pa.Array) -> np.ndarray:
    """A 64-bit hash for each string, without a loop over them. Only the sieve uses it, so collisions cost time alone."""
    offsets, data = _buffers(strings)
    lengths = np.diff(offsets)
    at = np.arange(len(data)) - np.repeat(offsets[:-1], lengths)
    powers = np.full(int(lengths.max(initial=0)) + 1, _MIX | np.uint64(1))
    powers = np.cumprod(powers, dtype=np.uint64)
    totals = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[at], dtype=np.uint64)])
    return _mixed(totals[offsets[1:]] - totals[offsets[:-1]])


def _buffers(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    strings = strings.cast(pa.large_string())
    offsets = np.frombuffer(strings.buffers()[1], np.int64)[strings.offset:strings.offset + len(strings) + 1]
    data = np.frombuffer(strings.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    return offsets - offsets[0], data


def _chunk_end(offsets: np.ndarray, data: np.ndarray, at: int) -> int:
    """The first end of a text or of a piece at or after a byte."""
    end = int(offsets[min(np.searchsorted(offsets, at), len(offsets) - 1)])
    for begin in range(at, end, CHUNK):
        breaks = np.flatnonzero(_KIND[data[begin:min(begin + CHUNK, end)]] == 2)
        if len(breaks):
            return begin + int(breaks[0])
    return end


def _chunks(texts: pa.Array) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """Lower-cased words of the texts, for each its piece and its text, some ``CHUNK`` bytes at a time."""
    offsets, data = _buffers(texts)
    begin = 0
    while begin < len(data):
        end = max(begin + 1, _chunk_end(offsets, data, begin + CHUNK))
        part = _KIND[data[begin:end]]
        inside = part == 0
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        heads = offsets[(offsets >= begin) & (offsets < end)] - begin
        first[heads] = inside[heads]
        starts = np.flatnonzero(first)
        if len(starts):
            upto = np.cumsum(inside, dtype=np.int32)
            word_ends = np.append(upto[starts] - 1, upto[-1]).astype(np.int32)
            letters = np.ascontiguousarray(_LOWER[data[begin:end][inside]])
            words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(word_ends), pa.py_buffer(letters))
            text = np.searchsorted(offsets, starts + begin, side="right") - 1
            piece = np.cumsum(part == 2, dtype=np.int32)[starts] + text
            yield words, piece, text
        begin = end


def _ranked(key: np.ndarray, code: np.ndarray, base: int) -> np.ndarray:
    """Numbers from 0 for the different pairs of ``key`` and ``code`` (below ``base``)."""
    return np.unique(key * np.int64(base) + code, return_inverse=True)[1].astype(np.int64)


def _stripes(size: int, longest: int, sieve) -> callable:
    """Stripes of all phrases of ``size`` words that pass the sieve, and hash counts of those with a word more.

    Both are combined within a chunk. The stripe of the empty prefix also has the number of all words, under no word.
    """
    def passes(h):
        bit = h >> np.uint64(64 - SIEVE_BITS)
        return (sieve.value[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1) == 1

    def batch(lang, prefix, heads, entries):
        lists = pa.ListArray.from_arrays(pa.array(np.append(heads, len(entries)).astype(np.int32)), entries)
        return pa.RecordBatch.from_arrays([lang, prefix, lists], ["lang", "prefix", "stripe"])

    def entries_of(following, counts, hashes=None):
        h = pa.nulls(len(counts), pa.int64()) if hashes is None else pa.array(hashes.astype(np.int64))
        return pa.StructArray.from_arrays([following, pa.array(counts), h], ["next", "n", "h"])

    def of_chunk(langs, lang_codes, lang_hashes, words, piece, text):
        word_hash, n = _hashes(words), len(words)
        lang = lang_codes[text]
        hashes = lang_hashes[lang]  # of the words read so far from each place on, in their language
        for j in range(size):
            hashes = _mixed(hashes[:n - j] * _MIX + word_hash[j:n])
        alive = piece[:len(hashes)] == piece[size - 1:size - 1 + len(hashes)]
        if size > 1:
            alive &= passes(hashes)
        else:
            of_lang = np.bincount(lang)
            seen = np.flatnonzero(of_lang)
            yield batch(langs.take(pa.array(seen)), pa.array([""] * len(seen)), np.arange(len(seen)),
                        entries_of(pa.nulls(len(seen), pa.string()), of_lang[seen]))
        places = np.flatnonzero(alive)
        if not len(places):
            return
        if size < longest:
            goes_on = np.flatnonzero(alive[:-1] & alive[1:])
            goes_on = goes_on[piece[goes_on] == piece[goes_on + size]]
            longer = _mixed(hashes[goes_on] * _MIX + word_hash[goes_on + size]) >> np.uint64(64 - BUCKET_BITS)
            bucket, counts = np.unique(longer, return_counts=True)
            yield batch(pa.nulls(1, pa.string()), pa.nulls(1, pa.string()), np.zeros(1, np.int32),
                        entries_of(pa.nulls(len(bucket), pa.string()), counts, bucket))
        used = np.zeros(n, bool)
        for j in range(size):
            used[places + j] = True
        used = np.flatnonzero(used)
        coded = words.take(pa.array(used)).dictionary_encode()
        known, codes = coded.dictionary, np.zeros(n, np.int64)
        codes[used] = coded.indices.to_numpy()
        key = lang[places]
        for j in range(size - 1):
            key = _ranked(key, codes[places + j], len(known))
        pair, where, counts = np.unique(key * np.int64(len(known)) + codes[places + size - 1], return_index=True, return_counts=True)
        heads = np.flatnonzero(np.diff(pair // len(known), prepend=-1))
        at = places[where[heads]]
        parts = [known.take(pa.array(codes[at + j])) for j in range(size - 1)]
        prefix = pc.binary_join_element_wise(*parts, " ") if parts else pa.array([""] * len(at))
        following = known.take(pa.array(codes[places[where] + size - 1]))
        yield batch(langs.take(pa.array(lang[at])), prefix, heads, entries_of(following, counts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            coded = rows.column("lang").dictionary_encode()
            lang_codes, lang_hashes = coded.indices.to_numpy().astype(np.int64), _hashes(coded.dictionary)
            for words, piece, text in _chunks(rows.column("body")):
                yield from of_chunk(coded.dictionary, lang_codes, lang_hashes, words, piece, text)
    return run


@contextmanager
def _setting(spark, name: str, value: str):
    """A session setting for the jobs that run inside."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def _sieve(spark, buckets: DataFrame | None):
    """One bit for the hash of every frequent phrase. A phrase that is not frequent may pass too, which changes no result."""
    bits = np.zeros(1 << (SIEVE_BITS - 6), np.uint64)
    if buckets is not None:
        at = F.shiftright("h", BUCKET_BITS - SIEVE_BITS)
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), at.bitwiseAND(F.lit(63)).cast("int"))
        for r in buckets.groupBy(F.shiftright(at, 6).alias("at")).agg(F.bit_or(bit).alias("set")).toLocalIterator():
            bits[r["at"]] = np.uint64(r["set"] & 0xFFFFFFFFFFFFFFFF)
    return spark.sparkContext.broadcast(bits)


def stripes(docs: DataFrame, longest: int = 4, least: int = 30) -> DataFrame:
    """Next-word counts of every prefix: (size, lang, prefix, next, n), where a phrase of ``size`` words is a prefix and its next word.

    Entries found at least ``least`` times are kept, and for each language one of the empty prefix without a word, the number of
    all words. Every pass over the texts fills the stripes of one length. Beside them it counts the hashes of phrases
    that are a word longer and whose two shorter parts passed, so that the next pass meets only phrases which can be frequent: what
    is shuffled are hash counts and the entries of frequent phrases. Chunks combine both before the shuffle; stripes are merged
    entry by entry, so that one with any number of entries is merged by many tasks.
    """
    spark = docs.sparkSession
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), whole_text("text").alias("body"))
    levels, buckets = [], None
    for size in range(1, longest + 1):
        made = texts.mapInArrow(_stripes(size, longest, _sieve(spark, buckets)), STRIPES)
        kept = (F.col("n") >= least) | (F.col("prefix").isNotNull() & F.col("next").isNull())
        with _setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", TEXTS_AT_ONCE):
            merged = materialize(made.select("lang", "prefix", F.inline("stripe")).groupBy("lang", "prefix", "next", "h")
                                 .agg(F.sum("n").alias("n")).where(kept))
        buckets = merged.where("prefix IS NULL")
        levels.append(merged.where("prefix IS NOT NULL").select(F.lit(size).alias("size"), "lang", "prefix", "next", "n"))
    return reduce(DataFrame.unionByName, levels)


def _joined(words: Column, start: Column, length: Column) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def score_of(scale: int) -> Column:
    """floor(scale * a / (l + r)) in whole numbers of 38 digits."""
    return F.expr(f"cast(cast({scale} as decimal(10, 0)) * cast(a as decimal(20, 0)) as decimal(38, 0)) "
                  "div (cast(l as decimal(37, 0)) + cast(r as decimal(37, 0)))")


def collocations(docs: DataFrame, longest: int = 4, least: int = 30, covered: int = 80, top: int = 2000) -> DataFrame:
    """The ``top`` phrases of every language: lang, rank, phrase, a, l, r, n, score.

    A-Z are lower-cased, texts are cut into pieces at ``BREAKS`` and these into words at blanks. A phrase of 2 to ``longest``
    words found a >= ``least`` times within pieces, overlaps included, is scored by its worst cut into two parts found l and r
    times: floor(2000000 * a / (l + r)), ties to the shortest first part; n is the language's number of words. A phrase is
    dropped if one that holds its words is found at least ``covered`` % as often; that phrase may be dropped itself. Order is
    by score and a, both descending, then by phrase.

    All numbers come from the stripes: an entry is a phrase's count, and so the total of the stripe whose prefix that phrase is.
    The greatest entry of a phrase's stripe, and of all entries that end with it, tell what covers it: any longer phrase
    holds one with a single word more, which is found as often at least.

    A NULL language is ``und``. NULL or empty texts have no word; a language without a phrase has no row. Repeated rows
    count each. Other columns are ignored; an empty table gives an empty result.
    """
    found = stripes(docs, longest, least)
    phrase = F.concat_ws(" ", F.when(F.col("size") > 1, F.col("prefix")), "next")
    frequent = found.where("next IS NOT NULL").select("lang", "size", "prefix", phrase.alias("phrase"), F.col("n").alias("a"))
    totals = frequent.where(F.col("size") < longest).select("lang", "phrase", "a")
    longer = frequent.where("size > 2")
    tail = F.col("phrase").substr(F.locate(" ", F.col("phrase")) + 1, F.length("phrase"))
    cover = (longer.select("lang", F.col("prefix").alias("phrase"), "a").unionByName(longer.select("lang", tail.alias("phrase"), "a"))
             .groupBy("lang", "phrase").agg(F.max("a").alias("most")))

    candidates = once(frequent.where("size > 1").select("lang", "phrase", "a"), words=F.split("phrase", " "))
    cuts = candidates.select("lang", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", _joined(F.col("words"), F.lit(1), F.col("k")).alias("first"),
                       _joined(F.col("words"), F.col("k") + 1, F.size("words")).alias("rest"))
    cuts = lookup_join(cuts, totals.toDF("lang", "first", "l"), ["lang", "first"])
    cuts = lookup_join(cuts, totals.toDF("lang", "rest", "r"), ["lang", "rest"])
    worst = F.min(F.struct(score_of(2_000_000).alias("score"), "k", "l", "r"))
    scored = cuts.groupBy("lang", "phrase", "a").agg(worst.alias("cut")).join(cover, ["lang", "phrase"], "left")
    left = scored.where(F.col("most").isNull() | (100 * F.col("most").cast("decimal(20,0)") < covered * F.col("a").cast("decimal(20,0)")))
    rows = left.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = rows.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return lookup_join(ranked, found.where("next IS NULL").select("lang", "n"), ["lang"]).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
