"""Resumable jobs: stages whose outputs are versions in a shared folder and count only once they are committed."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.ml.pipeline import PipelineModel
from pyspark.sql import DataFrame, Observation, Row, SparkSession, functions as F, types as T

MARKS = ("stage string, number long, version string, fingerprint string, tables map<string, long>, models array<string>, "
         "schemas map<string, string>")


@dataclass(frozen=True)
class Saved:
    """A committed stage: its tables and models, read back from its version's folder, and how many rows each table has."""
    stage: str
    version: str
    rows: dict[str, int] = field(default_factory=dict)
    tables: dict[str, DataFrame] = field(default_factory=dict)
    models: dict[str, object] = field(default_factory=dict)


class Stages:
    """The stages of one job under ``path``.

    A stage writes into a folder of its own that nothing reads before its commit mark, a row of the ``commits`` table, is
    written. What a stopped run leaves has no mark and is never seen. A stage runs again if its settings, or the version of a
    stage it reads, differ from those of its newest mark; else its saved version is used. ``log`` has (stage, "ran" or "saved").

    A mark has the schemas of its tables: finding them in the files would be a job for each table, whose broadcasts take
    4 MB of the driver each, however short the table.
    """

    def __init__(self, spark: SparkSession, path: str, before: Callable[[str], None] | None = None):
        self.spark, self.path, self.before = spark, path, before
        self.log: list[tuple[str, str]] = []
        spark.createDataFrame([], MARKS).write.mode("append").parquet(f"{path}/commits")

    def _newest(self, stage: str):
        marks = self.spark.read.schema(MARKS).parquet(f"{self.path}/commits").where(F.col("stage") == stage)
        return marks.orderBy(F.desc("number"), "version").first()

    def _saved(self, mark) -> Saved:
        base = f"{self.path}/{mark.stage}/{mark.version}"
        return Saved(mark.stage, mark.version, dict(mark.tables), {t: self._table(f"{base}/{t}", (mark.schemas or {}).get(t)) for t in mark.tables},
                     {m: PipelineModel.load(f"{base}/{m}") for m in mark.models})

    def _table(self, path: str, schema: str | None) -> DataFrame:
        """Marks of before schemas were kept have none."""
        reader = self.spark.read
        return (reader.schema(T.StructType.fromJson(json.loads(schema))) if schema else reader).parquet(path)

    def load(self, stage: str) -> Saved:
        """The newest committed version, whatever its settings."""
        mark = self._newest(stage)
        if mark is None:
            raise LookupError(f"no saved output of stage {stage}")
        self.log.append((stage, "saved"))
        return self._saved(mark)

    @staticmethod
    def _written(table: DataFrame, path: str) -> int:
        """Write a table and give its rows, counted by the pass that writes them."""
        seen = Observation()
        table.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(path)
        return seen.get["rows"]

    def run(self, stage: str, settings: str, make: Callable[[], tuple[dict[str, DataFrame], dict]], after: tuple[Saved, ...] = ()) -> Saved:
        """The output of ``make``, (tables, models), saved; or the saved one if nothing it depends on has changed."""
        depends = "\n".join([settings, *(f"{s.stage}/{s.version}" for s in after)])
        fingerprint = hashlib.md5(depends.encode()).hexdigest()
        mark = self._newest(stage)
        if mark is not None and mark.fingerprint == fingerprint:
            self.log.append((stage, "saved"))
            return self._saved(mark)
        if self.before:
            self.before(stage)
        number, version = (mark.number + 1 if mark else 1), uuid.uuid4().hex
        tables, models = make()
        base = f"{self.path}/{stage}/{version}"
        rows = {name: self._written(table, f"{base}/{name}") for name, table in tables.items()}
        for name, model in models.items():
            PipelineModel([model]).write().save(f"{base}/{name}")
        schemas = {name: table.schema.json() for name, table in tables.items()}
        done = Row(stage=stage, number=number, version=version, fingerprint=fingerprint, tables=rows, models=list(models), schemas=schemas)
        self.spark.createDataFrame([done], MARKS).coalesce(1).write.mode("append").parquet(f"{self.path}/commits")
        self.log.append((stage, "ran"))
        return self._saved(done)
