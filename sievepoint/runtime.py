"""Session settings, materialised intermediates and size checks shared by the operators."""

from __future__ import annotations

import re
import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

# A table is broadcast only when both measured bounds hold.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 * 1024 * 1024
# Measured bytes that all columns of one fitted table, or the leaves of one search, broadcast in a plan. The driver holds each of them several times over
# (collected, as a hash table, and in blocks for the executors), and those of a plan's few tables at the same time.
PLAN_BYTES = 4 * 1024 * 1024
JIT_OPTIONS = "-XX:-DontCompileHugeMethods"


def build_session(app: str = "sievepoint", master: str | None = None, **conf) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Files without a time zone hold UTC here; as timestamps their filters reach the scan.
        .config("spark.sql.parquet.inferTimestampNTZ.enabled", "false")
        # Wide rows generate methods the JVM would otherwise interpret.
        .config("spark.driver.extraJavaOptions", JIT_OPTIONS)
        .config("spark.executor.extraJavaOptions", JIT_OPTIONS)
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def cut_wide_steps(spark: SparkSession) -> None:
    """From now on steps over wide rows run operator by operator in this session.

    All operators of a step are generated as one loop, and over many columns it grows past the 8,000 bytes up to which the JVM
    compiles a method. It is interpreted then, in sessions without ``JIT_OPTIONS``. The code of a single operator is cut into methods
    short enough to be compiled; with this setting Spark takes it for such steps, and only for them.
    """
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")


def state_dir(spark: SparkSession) -> str:
    """Shared folder for written intermediates: the cluster's ``spark.checkpoint.dir``.

    Only a session in one process, as in tests, may fall back to a temporary folder; with executors of
    their own a missing setting is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="sievepoint-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir()


_scope: ContextVar[str | None] = ContextVar("scope", default=None)


@contextmanager
def scratch(spark: SparkSession):
    """Delete, on leaving, every intermediate written inside. Results must be written before that."""
    folder = f"{state_dir(spark)}/sievepoint/{uuid.uuid4().hex}"
    token = _scope.set(folder)
    try:
        yield folder
    finally:
        _scope.reset(token)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The written table survives the loss of executors, cuts the lineage, and gives the
    planner exact sizes for its join choice.
    """
    spark = df.sparkSession
    path = f"{_scope.get() or f'{state_dir(spark)}/sievepoint'}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, key: str) -> DataFrame:
    """Use all cores on an input of few row groups; an input with enough partitions is left alone."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def evened(df: DataFrame, most: int = 20_000) -> DataFrame:
    """``df``, dealt to all cores where one of its partitions has more than ``most`` rows and more than its share of them.

    The partitions of a scan are stretches of files, of which all but one have no rows if a file is one row group.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    sizes = df.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n"))
    size = sizes.agg(F.sum("n").alias("n"), F.max("n").alias("largest")).first()
    largest = size.largest or 0
    return df.repartition(cores) if largest > most and largest * cores > 2 * size.n else df


def measured_size(df: DataFrame) -> tuple[int, int]:
    """Rows and approximate payload bytes, as one distributed aggregate."""
    width = F.lit(0).cast("long")
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(field.name), F.lit(0)) + 16
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            # As text a nested value is about as long as its payload, numbers rather longer.
            width = width + F.coalesce(F.octet_length(F.col(f"`{field.name}`").cast("string")), F.lit(0)) + 16
        else:
            width = width + 16
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(width).alias("b")).first()
    return row.n, row.b or 0


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS,
                   max_bytes: int = BROADCAST_BYTES) -> bool:
    rows, size = measured_size(df)
    return rows <= max_rows and size <= max_bytes
