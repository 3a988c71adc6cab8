"""The whole batch job: extract, report, transform, split, prepare, train, test. Each part is a saved stage."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from sievepoint.constants import FILL_NUMBER, SCORE_THRESHOLD
from sievepoint.models.classifiers import assemble, blended, importance
from sievepoint.models.training import train
from sievepoint.operators.fitted import apply_scale, fit_scale
from sievepoint.operators.metrics import evaluate
from sievepoint.operators.reports import quality_report
from sievepoint.operators.rules import decide
from sievepoint.operators.splits import noise_features, noise_label, split_data
from sievepoint.operators.trim import feature_names
from sievepoint.plans.features import FeatureOptions, transform
from sievepoint.plans.stages import Saved, Stages
from sievepoint.plans.state import ready_lookups

STAGES = ("extract", "report", "transform", "split", "prepare", "train", "test")


@dataclass(frozen=True)
class Noise:
    """Factors N(1, level) on some features of a share of the rows, to see how much quality depends on them."""
    columns: tuple[str, ...]
    level: float = 1.0
    share: float = 0.6
    seed: int = 0


@dataclass(frozen=True)
class BatchOptions:
    """Settings of the job. ``split`` and ``train_split`` are arguments of ``split_data``; the first cuts off the test rows where
    no test source is given, the second is the holdout or the folds that training is judged by."""
    features: FeatureOptions
    declared_text: frozenset[str] = frozenset()
    report: bool = True
    split: dict = field(default_factory=lambda: {"method": "random", "share": 0.2})
    train_split: dict = field(default_factory=lambda: {"method": "random", "share": 0.2})
    scale: bool = False
    train_noise: Noise | None = None
    test_noise: Noise | None = None
    label_noise: float = 0.0
    kind: str = "boosted_trees"
    params: dict = field(default_factory=dict)
    threshold: float = SCORE_THRESHOLD


def _reports(rows: DataFrame, opts: BatchOptions) -> dict[str, DataFrame]:
    day = opts.features.as_of
    return {unit: quality_report(rows, day, unit, ts=opts.features.ts_column, threshold=opts.threshold) for unit in ("week", "month")}


def _features(encoded: DataFrame, opts: BatchOptions) -> list[str]:
    return [c for c in feature_names(encoded, opts.features.id_column) if c != "y_rule"]


def _listed(spark: SparkSession, names: list[str]) -> DataFrame:
    return spark.createDataFrame(list(enumerate(names)), "position int, name string")


def run_batch(spark: SparkSession, path: str, source: Callable[[], DataFrame], opts: BatchOptions,
              lookups: dict[str, DataFrame] | None = None, test_source: Callable[[], DataFrame] | None = None,
              stages: tuple[str, ...] = STAGES, before: Callable[[str], None] | None = None) -> tuple[dict[str, Saved], list]:
    """Run the job, or what is left of it, under ``path``: (saved stages, log of (stage, "ran" or "saved")).

    Sources are read by the extract alone. With a test source its rows are transformed by the state that the training rows
    gave; else the encoded rows are split. Noise is for judging only. Scaling is fitted on the training rows. A stage
    that is not in ``stages`` is loaded as it was saved last; a job that was stopped goes on where its last commit mark is.
    ``before`` is told the name of each stage that has to run.
    """
    store, done = Stages(spark, path, before), {}

    def step(name: str, settings, make, *after: str):
        needed = tuple(done[a] for a in after if a in done)
        done[name] = store.run(name, repr(settings), make, needed) if name in stages else store.load(name)

    def extract():
        return {"train": source(), **({"test": test_source()} if test_source else {})}, {}
    step("extract", test_source is not None, extract)
    raw = done["extract"].tables
    rates = [c for c in ("fraud_score", "fraud_status") if c in raw["train"].columns]
    if opts.report and len(rates) == 2 and "report" in stages:
        step("report", (opts.features.as_of, opts.threshold), lambda: (_reports(raw["train"], opts), {}), "extract")

    def transformed():
        # Scores and outcomes of the past are the report's; they are no features.
        # Lookups are made ready once, for the rows of both sources.
        known = ready_lookups(lookups) if opts.features.personal else lookups
        encoded, state = transform(raw["train"].drop(*rates), opts.features, known, None, set(opts.declared_text), "train")
        tables = {"train": encoded, "features": _listed(spark, _features(encoded, opts)), **{f"state_{n}": t for n, t in state.items()}}
        if "test" in raw:
            tables["test"] = transform(raw["test"].drop(*rates), opts.features, known, state, set(opts.declared_text), "test")[0]
        return tables, {}
    step("transform", (opts.features, sorted(opts.declared_text), sorted(lookups or {})), transformed, "extract")
    made = done["transform"].tables
    features = [r.name for r in made["features"].orderBy("position").collect()]
    key = opts.features.id_column

    def split():
        if "test" in made:
            return {"train": made["train"], "test": made["test"]}, {}
        rows = split_data(made["train"], key=key, **opts.split)
        return {"train": rows.where("NOT is_test").drop("is_test"), "test": rows.where("is_test").drop("is_test")}, {}
    step("split", opts.split, split, "transform")

    def prepared():
        parts = dict(done["split"].tables)
        for scope, noise in (("train", opts.train_noise), ("test", opts.test_noise)):
            if noise:
                parts[scope] = noise_features(parts[scope], key, list(noise.columns), noise.level, noise.share, noise.seed)
            parts[scope] = parts[scope].fillna(FILL_NUMBER, subset=[c for c in features if c in parts[scope].columns])
        tables = {}
        if opts.scale:
            numbers = {f.name for f in parts["train"].schema.fields if f.dataType.typeName() not in ("boolean", "string", "timestamp", "date")}
            scaled = [c for c in features if c in numbers]
            tables["scale"] = fit_scale(parts["train"], scaled)
            parts = {scope: apply_scale(rows, tables["scale"], scaled) for scope, rows in parts.items()}
        if opts.label_noise:
            parts = {scope: noise_label(rows, key, "y", opts.label_noise) for scope, rows in parts.items()}
        keep = {"train": (key, "ts"), "test": (key, "y_rule")}
        return {**tables, **{scope: assemble(rows, features, tuple(c for c in keep[scope] if c in rows.columns), "y")
                             for scope, rows in parts.items()}}, {}
    step("prepare", (opts.scale, opts.train_noise, opts.test_noise, opts.label_noise), prepared, "split")
    ready = done["prepare"].tables

    def trained():
        rows = split_data(ready["train"], key=key, **opts.train_split)
        by = {"fold": "fold"} if "fold" in rows.columns else {}
        model, scored, results = train(rows, opts.kind, opts.params, threshold=opts.threshold, **by)
        return {"scores": scored, "results": results, "importance": importance(spark, model, features, 10)}, {"model": model}
    step("train", (opts.kind, sorted(opts.params.items()), opts.threshold, opts.train_split), trained, "prepare")

    def tested():
        model = done["train"].models["model"].stages[0]
        scored = blended(ready["test"], model, opts.threshold)
        answers = scored.select(key, "label", "pred_fraud_prob", decide(F.col("pred_fraud_prob"), opts.threshold).alias("pred_fraud"))
        return {"answers": answers, "results": evaluate(answers, "label", "pred_fraud_prob", opts.threshold)}, {}
    step("test", opts.threshold, tested, "prepare", "train")
    return done, store.log
