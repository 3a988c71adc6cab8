"""Language of texts: scripts narrow the candidates, word scores and a switching penalty label spans."""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from sievepoint.llm.text import whole_text
from sievepoint.operators.lookup import lookup_join
from sievepoint.runtime import materialize

UNDETERMINED = "und"
# Bounds of the fit, all of it in tables of this size on the driver.
SAMPLE_ROWS = 20_000
FEATURES = 30_000
# A script is open to a language if it holds at least this share of the language's letters.
SCRIPT_SHARE = 0.001
# Log units: the most that one word can say for or against a language, and the price of a switch.
WORD_LIMIT = 10.0
SWITCH_PENALTY = 12.0
# The score of a language that is closed to a word which others are open to: no path goes there.
CLOSED = -1e9
# A span is evidence for its language if words that fit it hold this share of the span's letters.
FITTING_SHARE = 0.5
# Words labelled together, and words whose scores a task remembers.
WORDS_AT_ONCE = 2_000_000
WORDS_KEPT = 400_000
SCORED_AT_ONCE = 50_000



def _class_of(last: int, *kinds: str) -> str:
    """The characters of some Unicode categories, up to ``last``, as ranges of a pattern."""
    member = [unicodedata.category(chr(i))[0] in kinds for i in range(last + 1)]
    edges = np.flatnonzero(np.diff(np.array([False, *member, False]).astype(np.int8)))
    return "".join(f"\\U{a:08x}-\\U{b - 1:08x}" for a, b in zip(edges[::2], edges[1::2]))


# A letter and the letters and marks after it, in the fit and in the labelling. Beyond the basic plane a pattern tries range after
# range on every character that is no letter, so only texts that reach there use the whole one.
BASIC = 0xFFFF
BASIC_WORD, WORD = (re.compile(f"[{_class_of(last, 'L')}][{_class_of(last, 'L', 'M')}]*") for last in (BASIC, sys.maxunicode))
BEYOND_BASIC = re.compile("[\U00010000-\U0010ffff]")


def word_pattern(text: str) -> re.Pattern:
    return WORD if BEYOND_BASIC.search(text) else BASIC_WORD


WORD_IN_FIT = r"\p{L}[\p{L}\p{M}]*"
RESULT = "lang_pred string, score double, spans array<struct<start:int,end:int,lang:string>>"

# Unicode ranges of scripts, first and last code point.
SCRIPTS = {
    "latin": [(0x41, 0x24F), (0x1E00, 0x1EFF)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F)],
    "armenian": [(0x530, 0x58F)],
    "hebrew": [(0x590, 0x5FF)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F)],
    "devanagari": [(0x900, 0x97F)],
    "bengali": [(0x980, 0x9FF)],
    "tamil": [(0xB80, 0xBFF)],
    "thai": [(0xE00, 0xE7F)],
    "georgian": [(0x10A0, 0x10FF)],
    "hangul": [(0x1100, 0x11FF), (0xAC00, 0xD7AF)],
    "kana": [(0x3040, 0x30FF)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF)],
}


def _script_column(letter: Column) -> Column:
    code = F.ascii(letter)  # the code point of the first character
    out = F.lit("other")
    for name, ranges in SCRIPTS.items():
        for first, last in ranges:
            out = F.when(code.between(first, last), F.lit(name)).otherwise(out)
    return out


def script_of(word: str) -> str:
    code = ord(word[0].lower())
    return "latin" if code < 0x250 else next((s for s, ranges in SCRIPTS.items() if any(a <= code <= b for a, b in ranges)), "other")


@dataclass
class Model:
    """Log probabilities of features per language, those of an unknown trigram, and the languages open to each script."""
    langs: list[str]
    rows: dict[str, int]
    logs: np.ndarray
    open_to: dict[str, np.ndarray]
    floor: np.ndarray


def _features(word: Column) -> Column:
    """Trigrams of the word between its bounds; the whole word is told apart by a blank in front."""
    bounded = F.concat(F.lit("^"), word, F.lit("$"))
    grams = F.transform(F.sequence(F.lit(1), F.length(bounded) - 2), lambda i: bounded.substr(i, F.lit(3)))
    return F.concat(grams, F.array(F.concat(F.lit(" "), word)))


def fit(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, features: int = FEATURES) -> Model:
    """Fit word scores on rows with a text and a ``lang``.

    The fit reads about ``sample_rows`` rows, chosen by hash: as many of each language, and all of one that has fewer. Counts are
    made in Spark, and ``features`` features come to the driver, the most frequent of each language. So a
    language keeps its part of both however rare it is beside the others. Without labelled rows nothing can be told
    apart and every text gets ``und``.
    """
    labelled = docs.where("text IS NOT NULL AND lang IS NOT NULL")
    known = materialize(labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("rows")))
    n_langs = max(1, known.count())
    shares = known.select("lang", F.least(F.lit(1.0), F.lit(sample_rows / n_langs) / F.col("rows")).alias("share"))
    # Copies of one text are chosen one by one.
    chosen = F.xxhash64(*(c for c in ("doc_id", "text") if c in docs.columns))
    sample = (lookup_join(labelled.select("text", "lang", chosen.alias("mark")), shares, ["lang"])
              .where(F.pmod("mark", F.lit(1_000_000)) < F.round(F.col("share") * 1_000_000)))
    words = (sample.select("lang", F.explode(F.regexp_extract_all("text", F.lit(WORD_IN_FIT), 0)).alias("w"))
             .groupBy("lang", F.lower("w").alias("w")).agg(F.count(F.lit(1)).alias("n")).cache())
    scripts = words.groupBy("lang", _script_column(F.col("w")).alias("s")).agg(
        F.sum(F.col("n") * F.length("w")).alias("n")).collect()
    counts = words.select("lang", "n", F.explode(_features(F.col("w"))).alias("f")).groupBy("f", "lang").agg(F.sum("n").alias("n"))
    place = F.row_number().over(W.partitionBy("lang").orderBy(F.desc("n"), "f"))
    frequent = counts.withColumn("place", place).where(F.col("place") <= features // n_langs).select("f").distinct()
    by_feature = (counts.join(F.broadcast(frequent), "f").groupBy("f").agg(F.collect_list(F.struct("lang", "n")).alias("per"))
                  .orderBy("f").collect())
    words.unpersist()
    langs = sorted({r.lang for r in scripts})
    at = {name: i for i, name in enumerate(langs)}
    table = np.full((len(by_feature), len(langs)), 0.5)
    for i, row in enumerate(by_feature):
        for one in row.per:
            table[i, at[one.lang]] += one.n
    rows = {row.f: i for i, row in enumerate(by_feature)}
    whole = np.array([f.startswith(" ") for f in rows], bool)
    floor = np.log(0.5) - np.log(np.maximum(table[~whole].sum(axis=0), 1))
    for kind in (whole, ~whole):
        if kind.any():
            table[kind] = np.log(table[kind]) - np.log(table[kind].sum(axis=0))
    letters: dict[str, np.ndarray] = {}
    for r in scripts:
        letters.setdefault(r.s, np.zeros(len(langs)))[at[r.lang]] += r.n
    total = sum(letters.values(), np.zeros(len(langs)))
    return Model(langs, rows, table.astype(np.float32),
                 {s: n >= SCRIPT_SHARE * np.maximum(total, 1) for s, n in letters.items()}, floor.astype(np.float32))


class _Words(dict):
    """Numbers words as they are met, scores the new ones together, and keeps scores, lengths and where they fit.

    A word can stand in a language that its script is open to (``opens``). It fits (``fits``) if moreover its trigrams
    are on average likelier there than if all known trigrams were alike.
    """

    def __init__(self, model: Model):
        super().__init__()
        self.model, self.fresh = model, []
        self.scores, self.sizes = np.zeros((0, len(model.langs)), np.float32), np.zeros(0, np.int32)
        self.opens, self.fits = np.zeros((2, 0, len(model.langs)), bool)
        # One more row stands for features that are not known, and one for scripts that no language uses.
        self.logs = np.vstack([model.logs.reshape(-1, len(model.langs)), np.zeros((1, len(model.langs)), np.float32)])
        self.scripts = {s: i for i, s in enumerate(model.open_to)}
        # The same with what unknown trigrams cost; whole words say nothing about the fit.
        self.costs = np.vstack([np.where([[f.startswith(" ")] for f in model.rows], 0, model.logs).reshape(-1, len(model.langs)),
                                model.floor[None, :]]).astype(np.float32)
        self.alike = -np.log(max(1, sum(not f.startswith(" ") for f in model.rows)))
        self.open = np.array([*model.open_to.values(), np.zeros(len(model.langs), bool)])

    def __missing__(self, word: str) -> int:
        i = self[word] = len(self)
        self.fresh.append(word)
        return i

    def settle(self) -> None:
        """Score the words met since the last call."""
        parts = [self._scored(self.fresh[i:i + SCORED_AT_ONCE]) for i in range(0, len(self.fresh), SCORED_AT_ONCE)]
        for name, i in (("scores", 0), ("opens", 1), ("fits", 2)):
            setattr(self, name, np.concatenate([getattr(self, name), *(p[i] for p in parts)]))
        self.sizes = np.concatenate([self.sizes, np.fromiter(map(len, self.fresh), np.int32)])
        self.fresh = []

    def _scored(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        get, unknown, rows, starts = self.model.rows.get, len(self.logs) - 1, [], []
        for word in words:
            lowered = word.lower()
            bounded = f"^{lowered}$"
            starts.append(len(rows))
            rows.append(get(f" {lowered}", unknown))
            rows += [get(bounded[j:j + 3], unknown) for j in range(len(bounded) - 2)]
        said = np.add.reduceat(self.logs[rows], starts)
        allowed = self.open[[self.scripts.get(script_of(w), len(self.open) - 1) for w in words]]
        best = np.where(allowed, said, -np.inf).max(axis=1, keepdims=True)
        limited = np.maximum(said - np.where(np.isfinite(best), best, 0), -WORD_LIMIT)
        out = np.where(allowed, limited, CLOSED)
        out[~allowed.any(axis=1)] = 0
        grams = np.diff(np.append(starts, len(rows))) - 1
        cost = np.add.reduceat(self.costs[rows], starts)
        # The whole word comes first; where it is unknown its cost is not the word's.
        cost -= self.costs[[rows[i] for i in starts]]
        fits = allowed & (cost > grams[:, None] * self.alike)
        return out.astype(np.float32), allowed, fits


def best_paths(scores: np.ndarray, sizes: list[int], penalty: float) -> np.ndarray:
    """Viterbi labels of several word sequences laid end to end, stepping through all of them at once."""
    order = np.argsort(-np.array(sizes), kind="stable")
    length = np.array(sizes)[order]
    start = (np.concatenate([[0], np.cumsum(sizes)[:-1]]))[order]
    labels = np.zeros(len(scores), np.int16)
    stays = np.ones(scores.shape, bool)
    heads = np.zeros(len(scores), np.int16)
    value = np.zeros((len(sizes), scores.shape[1]))
    active = [int(np.searchsorted(-length, -t, "left")) for t in range(int(length[0]) if len(length) else 0)]
    for t, n in enumerate(active):
        at = start[:n] + t
        now = value[:n]
        if t:
            head = now.argmax(axis=1)
            top = now[np.arange(n), head] - penalty
            stays[at] = now >= top[:, None]
            heads[at] = head
            np.maximum(now, top[:, None], out=now)
        now += scores[at]
    label = value.argmax(axis=1) if len(sizes) else np.zeros(0, int)
    for t in range(len(active) - 1, -1, -1):
        n = active[t]
        at = start[:n] + t
        now = label[:n]
        labels[at] = now
        label[:n] = np.where(stays[at, now], now, heads[at])
    return labels


def _label_texts(texts: list[str], words: _Words, penalty: float) -> list[tuple]:
    """(language, score, spans) of each text; the spans tile it."""
    ids = [np.fromiter(map(words.__getitem__, word_pattern(t).findall(t)), np.int32) for t in texts]
    words.settle()
    langs, out = words.model.langs, []
    sizes = [len(x) for x in ids]
    flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
    labels = best_paths(words.scores[flat], sizes, penalty)
    owners = np.repeat(np.arange(len(sizes)), sizes)
    span = np.cumsum(np.concatenate([[0], (np.diff(labels) != 0) | (np.diff(owners) != 0)])[:len(flat)]).astype(int)
    open_letters = words.sizes[flat] * words.opens[flat, labels]
    counted, fitting = (np.bincount(span, weights=x) for x in (open_letters, words.sizes[flat] * words.fits[flat, labels]))
    borne_out = open_letters * (fitting >= FITTING_SHARE * counted)[span]
    at = 0
    for text, own, n in zip(texts, ids, sizes):
        if not n:
            out.append((UNDETERMINED, 0.0, []))
            continue
        mine, sure = labels[at:at + n], borne_out[at:at + n]
        at += n
        letters = np.bincount(mine, weights=words.sizes[own], minlength=len(langs))
        best = int(letters.argmax())
        turns = np.flatnonzero(np.diff(mine)) + 1
        starts = [0]
        if len(turns):
            places = [m.start() for m in word_pattern(text).finditer(text)]
            starts += [places[i] for i in turns]
        ends = starts[1:] + [len(text)]
        kinds = [langs[mine[i]] for i in [0, *turns]]
        out.append((langs[best], float(sure[mine == best].sum() / letters.sum()),
                    [{"start": s, "end": e, "lang": k} for s, e, k in zip(starts, ends, kinds)]))
    return out


def label(text: Column, model: Model, penalty: float = SWITCH_PENALTY) -> Column:
    """Struct (lang_pred, score, spans) for each text; ``spans`` are code point ranges that tile the text.

    ``lang_pred`` is the language with most letters. ``score`` is the share of the text's letters that bear it out:
    letters in a script open to it, in its spans, where words that fit the language hold at least half of them. A
    text in a script that no learned language uses, or of strings that no language would form, scores near 0.
    A text that is NULL, empty or without a letter gets ``und``, 0 and no span. Memory holds ``WORDS_AT_ONCE`` words or one text, whichever is more.
    """
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        words = _Words(model)
        for batch in batches:
            out, held, size = [], [], 0
            for t in batch:
                held.append(t or "")
                size += len(held[-1]) // 6
                if size > WORDS_AT_ONCE:
                    out += _label_texts(held, words, penalty)
                    held, size = [], 0
                    words = words if len(words) < WORDS_KEPT else _Words(model)
            out += _label_texts(held, words, penalty)
            words = words if len(words) < WORDS_KEPT else _Words(model)
            yield pd.DataFrame(out, columns=["lang_pred", "score", "spans"])

    def none(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([(UNDETERMINED, 0.0, [])] * len(batch), columns=["lang_pred", "score", "spans"])

    return F.pandas_udf(of if model.langs else none, RESULT)(text)


def held_out(doc_id: Column) -> Column:
    """True for the quarter of ids that a fit never reads; NULL for a NULL id."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2


def identify(docs: DataFrame, model: Model | None = None, penalty: float = SWITCH_PENALTY) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``spans`` (columns of these names are replaced).

    Without a model one is fitted on the rows whose id is not held out. Rows with a NULL id are labelled but
    not learned from. Repeated rows are labelled alike; an empty table stays empty.
    """
    model = model or fit(docs.where(~held_out(F.col("doc_id"))))
    named = docs.select(F.struct("*").alias("row"), label(whole_text("text"), model, penalty).alias("found"))
    keep = [c for c in docs.columns if c not in ("lang_pred", "score", "spans")]
    return named.select(*(F.col("row")[c].alias(c) for c in keep), "found.lang_pred", "found.score", "found.spans")


def keep_identified(docs: DataFrame, least_share: float = 0.5) -> DataFrame:
    """Rows whose text has a language borne out by ``least_share`` of its letters (``score``); columns unchanged."""
    named = docs.select(F.struct("*").alias("row"), "doc_id", "text", "lang")
    return identify(named).where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= least_share)).select("row.*")
