"""Mix sources to target weights by Poisson replication."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from sievepoint.llm.text import whole_text
from sievepoint.runtime import fits_broadcast, materialize


def unit_hash(*parts: Column) -> Column:
    """Uniform in [0, 1): the first 52 bits of an md5."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 13), 16, 10).cast("double") / float(1 << 52)


# Copies that one step of numbering holds at a time.
NUMBERED = 65_536


def _log_factorial(n: Column) -> Column:
    """Logarithm of n! by Stirling's series, which double precision cannot tell from it for n of 20 and more."""
    return (n + 0.5) * F.log(n) - n + 0.5 * math.log(2 * math.pi) + 1 / (12 * n) - 1 / (360 * n ** 3) + 1 / (1260 * n ** 5) - 1 / (1680 * n ** 7)


def poisson_thresholds(rates: DataFrame) -> DataFrame:
    """(of, low, upto) for (source, rate): ``upto`` has P(count <= j) for j = low, low + 1, ... until it is 1 in double precision.

    Only counts within 12 standard deviations are held, outside which less than the last bit of a double lies; so there are about
    24 square roots of the rate of them. Terms follow from one another by their ratio, rate / j, in logarithms.
    """
    root = F.sqrt("rate")
    under = F.floor(F.col("rate") - 12 * root)
    low = F.when(under < 20, F.lit(0).cast("long")).otherwise(under)
    high = F.ceil(F.col("rate") + 12 * root) + 30
    spread = rates.select(F.col("source").alias("of"), "rate", low.alias("low"), F.explode(F.sequence(low, high)).alias("j"))
    first = F.when(F.col("low") == 0, -F.col("rate")).otherwise(
        F.col("low") * F.log("rate") - F.col("rate") - _log_factorial(F.col("low").cast("double")))
    change = F.when(F.col("j") == F.col("low"), first).otherwise(F.log("rate") - F.log(F.col("j").cast("double")))
    # One source's counts, which grow with the root of its rate; the documents are not here.
    upwards = W.partitionBy("of").orderBy("j").rowsBetween(W.unboundedPreceding, W.currentRow)
    summed = spread.withColumn("log_p", F.sum(change).over(upwards)).withColumn("p", F.sum(F.exp("log_p")).over(upwards))
    listed = F.sort_array(F.collect_list(F.struct("j", "p")))
    return summed.groupBy("of").agg(F.min("low").alias("low"), F.transform(listed, lambda x: x["p"]).alias("upto"))


def poisson_count(u: Column, low: Column, upto: Column, most: int) -> Column:
    """Least j with P(count <= j) > u, by halving ``upto``, which has ``most`` values at most."""
    steps = F.array(*(F.lit(1 << b) for b in reversed(range(max(1, most.bit_length())))))
    under = F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(upto, at + step - 1) <= u, at + step).otherwise(at))
    return low + under


def source_rates(docs: DataFrame, weights: dict[str, float], epochs: float = 1.0) -> DataFrame:
    """Mean repetitions per source: (source, chars, weight, rate).

    ``weights`` are shares of characters; what they leave of 1 is shared evenly by the sources not named (NULL is
    a source like any other). The mix has ``epochs`` times the characters of the input. A source without
    characters is not repeated at all.
    """
    left = 1.0 - sum(weights.values())
    if left < -1e-9 or min(weights.values(), default=0) < 0:
        raise ValueError("weights must be at least 0 and sum to 1 at most")
    sizes = docs.groupBy("source").agg(F.sum(F.length(whole_text("text"))).cast("double").alias("chars"))
    given = F.lit(None).cast("double")
    for name, weight in weights.items():
        given = F.when(F.col("source") == name, F.lit(float(weight))).otherwise(given)
    sizes = materialize(sizes.withColumn("given", given))
    rest = sizes.agg(F.sum("chars").alias("all"), F.count(F.when(F.col("given").isNull() & (F.col("chars") > 0), 1)).alias("n")).first()
    share = F.coalesce("given", F.lit(max(0.0, left) / max(1, rest.n)))
    return sizes.select("source", "chars", share.alias("weight"),
                        F.when(F.col("chars") > 0, share * float(epochs) * float(rest["all"] or 0) / F.col("chars"))
                        .otherwise(F.lit(0.0)).alias("rate"))


def mix_sources(docs: DataFrame, weights: dict[str, float], seed: str = "mix", epochs: float = 1.0) -> DataFrame:
    """Repeat each document a Poisson number of times and shuffle all copies.

    A document's number is the least j with P(count <= j) > u, where the mean is its source's rate and u a hash
    of seed and id (of the text where the id is NULL). So the mix is the same however rows are dealt, and no
    source is gathered anywhere: source sizes are summed before they are shuffled, and a document only meets
    its source's thresholds. Copies are ordered by a hash of seed, id and copy number; they are dealt to
    partitions by it and sorted in each, which is a random order of the whole.

    Returns ``docs`` with ``copy_no`` (from 1) and ``order_key`` in [0, 1) added; columns of these names are
    replaced. Repeated rows get the same number of copies. A NULL text has no characters but is repeated as its
    source is. An empty table gives an empty result.
    """
    rates = source_rates(docs, weights, epochs)
    table = materialize(poisson_thresholds(rates.where("rate > 0")))
    most = table.agg(F.max(F.size("upto"))).first()[0] or 0
    table = F.broadcast(table) if fits_broadcast(table) else table
    ident = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text:"), F.md5(whole_text("text"))))
    rows = docs.select(F.struct("*").alias("row"), F.col("source").alias("own"), ident.alias("ident"))
    u = unit_hash(F.lit(seed), F.col("ident"))
    copies = poisson_count(F.col("u"), F.col("low"), F.col("upto"), most)
    last = F.least(F.col("first") + (NUMBERED - 1), F.col("n"))
    counted = (rows.withColumn("u", u).join(table, F.col("own").eqNullSafe(F.col("of")))
               .select("row", "ident", copies.alias("n")).where("n > 0")
               .select("row", "ident", "n", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"), F.lit(NUMBERED).cast("long"))).alias("first"))
               .select("row", "ident", F.explode(F.sequence(F.col("first").cast("int"), last.cast("int"))).alias("copy_no"))
               .select("row", "copy_no", unit_hash(F.lit(seed), F.lit("order"), F.col("ident"), F.col("copy_no").cast("string")).alias("order_key")))
    names = [c for c in docs.columns if c not in ("copy_no", "order_key")]
    return (counted.repartition(F.col("order_key")).sortWithinPartitions("order_key")
            .select(*(F.col("row")[c].alias(c) for c in names), "copy_no", "order_key"))
