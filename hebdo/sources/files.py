"""File sources (R1-R9). Schemas are always given, never inferred."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hebdo.operators.boosting import BoostedTrees
from hebdo.sources import schemas as S


def _read(spark: SparkSession, path: str, schema: T.StructType, fmt: str) -> DataFrame:
    r = spark.read.schema(schema)
    if fmt == "csv":
        return r.option("header", True).option("mode", "FAILFAST").csv(path)
    if fmt == "json":
        return r.option("mode", "FAILFAST").json(path)
    return r.parquet(path)


def read_customers(spark, path, fmt="csv"):
    """R1."""
    return _read(spark, path, S.CUSTOMERS, fmt)


def read_invoices(spark, path, fmt="csv"):
    """R2."""
    return _read(spark, path, S.INVOICES, fmt)


def read_payments(spark, path, fmt="csv"):
    """R3."""
    return _read(spark, path, S.PAYMENTS, fmt)


def read_weekly(spark, path, fmt="parquet", keys: list[str] | None = None):
    """Weekly metrics; a missing path raises Spark's PATH_NOT_FOUND."""
    keys = list(keys or [])
    schema = T.StructType([T.StructField(k, T.StringType()) for k in keys] + S.WEEKLY.fields)
    return _read(spark, path, schema, fmt)


def read_features(spark, path, keys: list[str] | None = None, fmt="parquet"):
    """Model-ready table (week order is carried by windows, not files)."""
    from hebdo.operators.features import FEATURES, TARGET
    keys = list(keys or [])
    schema = T.StructType([T.StructField(k, T.StringType()) for k in keys]
                          + [T.StructField("week", T.DateType()), T.StructField(TARGET, T.DoubleType())]
                          + [T.StructField(f, T.DoubleType()) for f in FEATURES])
    return _read(spark, path, schema, fmt)


def read_params(spark, path, default: dict | None = None) -> dict:
    """Tuned parameters (one JSON record) as a plain dict; ``default``, if
    given, where nothing was written."""
    try:
        row = _read(spark, path, S.PARAMS, "json").first()
    except AnalysisException as e:
        if default is None or e.getCondition() != "PATH_NOT_FOUND":
            raise
        return dict(default)
    return {k: v for k, v in row.asDict().items() if v is not None}


def read_health(spark, path, keys: list[str] | None = None) -> DataFrame:
    """Latest health summary per series (walk-forward runs win over
    training runs, then the newest run); empty when nothing was written."""
    keys = list(keys or [])
    schema = T.StructType([T.StructField(k, T.StringType()) for k in keys] + S.SUMMARY.fields + [
        T.StructField("run_kind", T.StringType()), T.StructField("run_ts", T.TimestampType())])
    try:
        df = _read(spark, path, schema, "json")
        df.schema  # noqa: B018 - resolves the path
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    rank = F.struct((F.col("run_kind") == "walk_forward").cast("int"), F.col("run_ts"))
    best = F.max_by(F.struct(*[c for c in schema.names if c not in keys]), rank)
    return df.groupBy(*keys).agg(best.alias("_b")).select(*keys, "_b.*")


def read_residuals(spark, path, keys: list[str] | None = None) -> DataFrame:
    """(keys, week, abs_error, model, run_kind, run_id, run_ts)."""
    keys = list(keys or [])
    schema = T.StructType(
        [T.StructField(k, T.StringType()) for k in keys]
        + [T.StructField("week", T.DateType()), T.StructField("abs_error", T.DoubleType()),
           T.StructField("model", T.StringType()), T.StructField("run_kind", T.StringType()),
           T.StructField("run_id", T.StringType()), T.StructField("run_ts", T.TimestampType())])
    return _read(spark, path, schema, "parquet")


def latest_run(runs: DataFrame) -> DataFrame:
    """Rows of one run per model: the newest walk-forward run, else the newest
    of the other kinds. The runs table has one row per model and run."""
    rank = F.struct((F.col("run_kind") == "walk_forward").cast("int"), F.col("run_ts"), F.col("run_id"))
    last = runs.groupBy("model").agg(F.max_by("run_id", rank).alias("run_id"))
    return runs.join(last, ["model", "run_id"], "left_semi")


def load_model(spark, path: str) -> BoostedTrees:
    """A forest from its node table; a missing path raises."""
    return BoostedTrees.load(spark, path)
