"""Block-list and time-limit rules, label overrides, and the rule/model blend."""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sievepoint import constants as K
from sievepoint.functions import identity as I
from sievepoint.operators.lookup import in_list
from sievepoint.sources.readers import read_word_list


@dataclass(frozen=True)
class RuleOptions:
    override: bool = True
    override_tagging: bool = True
    time_limit: float | None = K.RULE_MAX_SECONDS
    period_list: tuple[str, ...] | None = None
    address_list: tuple[str, ...] | None = K.ADDRESS_DOMAIN_LIST
    top_domain_list: tuple[str, ...] | None = K.TOP_DOMAIN_LIST
    anonymized_email: bool = False


# Entries of a list file, at most: the lists are part of every plan.
LISTED = 10_000


def options_from_files(spark: SparkSession, base: RuleOptions = RuleOptions(), **files: str) -> RuleOptions:
    """``base`` with lists read from files of one entry a line: ``period_list``, ``address_list``, ``top_domain_list``.

    Entries are trimmed, lower-cased and taken once, blank lines left out. An empty file makes an empty list, whose rule never
    fires. A list of more than ``LISTED`` entries is refused.
    """
    read = {}
    for name, path in files.items():
        words = [r.value for r in read_word_list(spark, path).orderBy("value").limit(LISTED + 1).collect()]
        if len(words) > LISTED:
            raise ValueError(f"{name}: more than {LISTED} entries")
        read[name] = tuple(words)
    return replace(base, **read)


def time_limit_rule(seconds: Column, limit: float = K.RULE_MAX_SECONDS) -> Column:
    return F.coalesce(seconds <= limit, F.lit(False))


def period_rule(email: Column, domains=K.PERIOD_DOMAIN_LIST) -> Column:
    dotted = F.coalesce(I.email_handle(email).contains("."), F.lit(False))
    return dotted & in_list(I.email_domain(email), domains)


def address_rule(email: Column, domains=K.ADDRESS_DOMAIN_LIST) -> Column:
    return in_list(I.email_domain(email), [d.lower() for d in domains])


def top_domain_rule(email: Column, labels=K.TOP_DOMAIN_LIST) -> Column:
    return in_list(I.last_label(email), [d.lower() for d in labels])


def active_rules(options: RuleOptions, columns) -> list[Column]:
    if not options.override:
        return []
    rules = []
    if options.time_limit is not None:
        rules.append(time_limit_rule(F.col("app_duration"), options.time_limit))
    if "email" in columns and not options.anonymized_email:
        email = F.col("email")
        if options.period_list is not None:
            rules.append(period_rule(email, options.period_list))
        if options.address_list is not None:
            rules.append(address_rule(email, options.address_list))
        if options.top_domain_list is not None:
            rules.append(top_domain_rule(email, options.top_domain_list))
    return rules


def rule_flag(df: DataFrame, options: RuleOptions = RuleOptions(), name: str = "y_rule") -> DataFrame:
    """Add 0/1 for "any active rule fires"; NULL when no rule is active."""
    rules = active_rules(options, df.columns)
    flag = reduce(lambda a, b: a | b, rules).cast("int") if rules else F.lit(None).cast("int")
    return df.withColumn(name, flag)


def override_label(label: Column, seconds: Column, limit: float = K.RULE_MAX_SECONDS) -> Column:
    """A duration strictly under the limit forces the label to true."""
    return F.when(seconds < limit, True).otherwise(label)


def merge_rule_label(label: Column, rule: Column) -> Column:
    return F.coalesce(label, F.lit(False)) | (F.coalesce(rule, F.lit(0)) == 1)


def blend(prob: Column, rule: Column, threshold: float = K.SCORE_THRESHOLD) -> Column:
    """A firing rule lifts a probability at or under the threshold to 1."""
    return F.when((rule == 1) & (prob <= threshold), 1.0).otherwise(prob)


def decide(prob: Column, threshold: float = K.SCORE_THRESHOLD, strict: bool = True) -> Column:
    """0/1 class; scoring is strict, reports and the model lab count the threshold itself as 1."""
    return (prob > threshold if strict else prob >= threshold).cast("int")
