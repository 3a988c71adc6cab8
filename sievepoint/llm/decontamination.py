"""Find passages of benchmark items in documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sievepoint.llm.text import joined_in_blocks, lower_ascii, once, row_keys, whole_text
from sievepoint.runtime import materialize

# Everything in ASCII but digits and lower-case letters parts words.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(text), SEPARATORS), "")


def _token(words: str, at: Column, size: int) -> Column:
    return F.xxhash64(*(F.get(F.col(words), at + j) for j in range(size)))


def _document_shingles(docs: DataFrame, size: int) -> DataFrame:
    """One row per shingle. The outer form keeps the optimizer from splitting the text a second time for a filter."""
    last = F.size("words") - size
    positions = F.when(last >= 0, F.sequence(F.lit(0), last))
    return (docs.select("*", F.explode_outer(positions).alias("p")).where(F.col("p").isNotNull())
            .withColumn("token", _token("words", F.col("p"), size)))


def _anchors(docs: DataFrame, items: DataFrame, size: int, window: int) -> DataFrame:
    """For each item window its rarest shingle, which any document with that window must hold.

    Windows of one item that share their rarest shingle make one row: the words they span, the place of
    the shingle in them, and the window length. ``items`` holds (seq, words) with at least ``size`` words.
    """
    length = F.least(F.size("words"), F.lit(window))
    placed = (items.select("seq", "words", F.explode(F.sequence(F.lit(0), F.size("words") - size)).alias("q"))
              .select("seq", "q", _token("words", F.col("q"), size).alias("token")))
    wanted = placed.select("token").distinct()
    counts = (joined_in_blocks(_document_shingles(docs.select("words"), size).select("token"), wanted, "token")
              .groupBy("token").agg(F.count(F.lit(1)).alias("n")))
    ranked = (placed.join(counts, "token", "left")
              .groupBy("seq").agg(F.array_sort(F.collect_list(F.struct(
                  "q", F.coalesce("n", F.lit(0).cast("long")).alias("n"), "token"))).alias("tokens")))
    by_rarity = F.transform("tokens", lambda t: F.struct(t["n"].alias("n"), t["q"].alias("q"), t["token"].alias("token")))
    return (items.join(ranked, "seq")
            .select("seq", "words", length.alias("len"), by_rarity.alias("tokens"))
            .select("seq", "words", "len", "tokens",
                    F.explode(F.sequence(F.lit(0), F.size("words") - F.col("len"))).alias("start"))
            .select("seq", "words", "len", "start",
                    F.array_min(F.slice("tokens", F.col("start") + 1, F.col("len") - size + 1)).alias("rarest"))
            .groupBy("seq", "len", F.col("rarest.q").alias("q"), F.col("rarest.token").alias("token"))
            .agg(F.min("start").alias("lo"), F.max("start").alias("hi"), F.first("words").alias("words"))
            .select("token", "seq", "len", (F.col("q") - F.col("lo")).alias("offset"),
                    F.slice("words", F.col("lo") + 1, F.col("hi") - F.col("lo") + F.col("len")).alias("part")))


def _occurrences(docs: DataFrame, anchors: DataFrame, size: int) -> DataFrame:
    """Verified windows as (k1, k2, seq, spans); each span is a word range of the document."""
    base = F.col("p") - F.col("offset")
    at = F.greatest(F.lit(0), base)
    met = joined_in_blocks(_document_shingles(docs, size), anchors, "token")
    # Only the words beside the shingle go on; a long text must not be copied for each of its candidates.
    met = once(met, near=F.slice("words", at + 1, F.greatest(F.lit(0), F.size("part") - (at - base))), at=at, skip=at - base)
    met = met.select("k1", "k2", "seq", "len", "part", "near", "at", "skip")
    last = F.size("near") - F.col("len")
    same = F.filter(
        F.when(last >= 0, F.sequence(F.lit(0), last)),
        lambda j: F.slice("near", j + 1, F.col("len")) == F.slice("part", F.col("skip") + j + 1, F.col("len")))
    spans = F.transform(same, lambda j: F.struct((F.col("at") + j).alias("s"), (F.col("at") + j + F.col("len")).alias("e")))
    return met.select("k1", "k2", "seq", spans.alias("spans")).where(F.size("spans") > 0)


def find_passages(docs: DataFrame, benchmark: DataFrame, window: int = 10, shingle: int = 3) -> DataFrame:
    """Mark the words of each document that lie in a passage of a benchmark item.

    A passage is ``window`` consecutive item words; an item of fewer words is one passage. The join is
    prefix-filtered: shingles of ``shingle`` words are ordered by how rare they are in all documents, and
    since a document that contains a passage contains its rarest shingle, only that one is joined. Length
    and position bounds drop places where the passage cannot fit, and the rest is compared word by word.
    The item side is counted and broadcast in blocks of bounded size, so no document word is shuffled.

    Returns one row per document row: ``doc_id``, ``n_words``, ``n_hit`` (words in any passage),
    ``item_ids`` (sorted strings), ``spans`` (merged word ranges, end exclusive), ``contaminated``.
    A NULL or empty text has no words and no hits; items without words never match; an item without an
    id hits words but is not listed. Repeated rows come back as often as they are given. Other columns
    of either table are ignored. An empty benchmark leaves every document clean.
    """
    rows = docs.select("doc_id", *row_keys(F.col("doc_id"), F.col("text")), words_of(whole_text("text")).alias("words"))
    named = (benchmark.select(F.col("item_id").cast("string").alias("item"), words_of(whole_text("text")).alias("words"))
             .where(F.size("words") > 0)
             .withColumn("seq", F.xxhash64("words")))
    named = materialize(named)
    unique = named.select("seq", "words").distinct()
    found = None
    # Items shorter than a shingle are joined by themselves as one shingle of their own size.
    sizes = sorted(r.n for r in named.select(F.least(F.size("words"), F.lit(shingle)).alias("n")).distinct().collect())
    for size in sizes:
        own = unique.where(F.size("words") >= size if size == shingle else F.size("words") == size)
        anchors = materialize(_anchors(rows, own, size, window))
        part = _occurrences(rows.select("k1", "k2", "words"), anchors, size)
        found = part if found is None else found.unionByName(part)
    counted = rows.select("doc_id", "k1", "k2", F.size("words").cast("long").alias("n_words"))
    empty_ids, empty_spans = F.array().cast("array<string>"), F.array().cast("array<struct<s:int,e:int>>")
    if found is None:
        return counted.select("doc_id", "n_words", F.lit(0).cast("long").alias("n_hit"), empty_ids.alias("item_ids"),
                              empty_spans.alias("spans"), F.lit(False).alias("contaminated"))
    # A document's own spans bound what meets here, however many documents share a passage.
    found = materialize(found.groupBy("k1", "k2").agg(
        F.array_distinct(F.flatten(F.collect_set("spans"))).alias("spans"), F.collect_set("seq").alias("seqs")))
    listed = (joined_in_blocks(found.select("k1", "k2", F.explode("seqs").alias("seq")),
                               named.where("item IS NOT NULL").select("seq", "item").distinct(), "seq")
              .groupBy("k1", "k2").agg(F.array_sort(F.collect_set("item")).alias("item_ids")))
    merged = F.aggregate(
        F.array_sort("spans"), empty_spans,
        lambda acc, x: F.when(
            (F.size(acc) > 0) & (F.element_at(acc, -1)["e"] >= x["s"]),
            F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(F.struct(
                F.element_at(acc, -1)["s"].alias("s"), F.greatest(F.element_at(acc, -1)["e"], x["e"]).alias("e")))),
        ).otherwise(F.concat(acc, F.array(x))))
    hits = found.select("k1", "k2", merged.alias("spans")).join(listed, ["k1", "k2"], "left")
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, x: acc + (x["e"] - x["s"]))
    return (counted.join(hits, ["k1", "k2"], "left")
            .select("doc_id", "n_words", F.coalesce(n_hit, F.lit(0).cast("long")).alias("n_hit"),
                    F.coalesce("item_ids", empty_ids).alias("item_ids"),
                    F.coalesce("spans", empty_spans).alias("spans"), F.col("spans").isNotNull().alias("contaminated")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10, shingle: int = 3) -> DataFrame:
    """``docs`` without the rows that hold a benchmark passage; all other rows and columns unchanged."""
    rows = docs.select(F.struct("*").alias("row"), *row_keys(F.col("doc_id"), F.col("text")))
    keyed = rows.select(F.struct("k1", "k2").alias("doc_id"), F.col("row.text").alias("text"))
    bad = (find_passages(keyed, benchmark, window, shingle).where("contaminated")
           .select("doc_id.k1", "doc_id.k2").distinct())
    return rows.join(bad, ["k1", "k2"], "left_anti").select("row.*")
