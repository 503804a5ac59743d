"""Distributed gradient-boosted forecaster on the gold datasets (Spark ML).

Categorical columns are indexed with codes fixed at training time (unseen values get their
own code), numeric features get a sentinel for NULL/NaN plus a 0/1 missing flag (Spark's
trees reject NaN vectors), everything is assembled into one vector, and a GBTRegressor is
fitted before a time cutoff, judged after it round by round, then refitted on all rows.
Training and prediction are Spark jobs over the whole table; the driver gets the distinct labels of the
categorical columns and one error per round."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType

from loadcast.session import ensure_checkpoint_dir

# Categorical features of the hourly/monthly datasets (weather_key first when used).
BASE_CATEGORICALS = ("group_id", "desc", "macro_region", "region", "municipality", "segment", "product_type",
                     "consumption_bucket")
# Validation cutoffs per frequency.
VALIDATION_CUTOFFS = {"hourly": "2024-09-15 00:00:00", "monthly": "2023-10-01 00:00:00"}

TARGET = "target_consumption"
SENTINEL = -1.0e9


def categorical_columns(include_weather: bool) -> list[str]:
    return (["weather_key"] if include_weather else []) + list(BASE_CATEGORICALS)


def validation_cutoff(frequency: str) -> str:
    if frequency not in VALIDATION_CUTOFFS:
        raise ValueError(f"Unsupported frequency: {frequency}")
    return VALIDATION_CUTOFFS[frequency]


def artifact_name(frequency: str, variant: str = "") -> str:
    """``{frequency}[_{variant}]``: names model directories and prediction tables."""
    return f"{frequency}_{variant}" if variant else frequency


def feature_columns(df: DataFrame, target: str = TARGET, ts: str = "timestamp_utc") -> list[str]:
    """Every column except the target and the timestamp."""
    return [c for c in df.columns if c not in (target, ts)]


def _numeric_prepare(df: DataFrame, numeric: Sequence[str]) -> tuple[DataFrame, list[str]]:
    cols, out = {}, []
    for c in numeric:
        v = F.col(c).cast("double")
        missing = v.isNull() | F.isnan(v)
        cols[f"{c}__x"] = F.when(missing, F.lit(SENTINEL)).otherwise(v)
        cols[f"{c}__missing"] = missing.cast("double")
        out += [f"{c}__x", f"{c}__missing"]
    return df.withColumns(cols), out


def stop_round(errors: Sequence[float], patience: int) -> int:
    """The round (from 1) that a stop rule keeps: the best one seen before ``patience`` rounds in a row bring
    nothing better; the earlier one of ties. 0 without rounds."""
    best = 0
    for k in range(len(errors)):
        if errors[k] < errors[best]:
            best = k
        elif k - best >= patience:
            break
    return best + 1 if errors else 0


@dataclass
class Forecaster:
    """A fitted forecaster. ``validation_errors``: mean absolute error on the validation rows after each round;
    ``best_round`` and ``validation_mae``: what the stop rule keeps of them (None without a cutoff or such rows)."""

    indexer: PipelineModel
    model: PipelineModel
    categoricals: list[str]
    numeric: list[str]
    validation_mae: float | None = None
    best_round: int | None = None
    validation_errors: list[float] = field(default_factory=list)

    def prepare(self, df: DataFrame) -> DataFrame:
        staged = df.withColumns({c: F.col(c).cast("string") for c in self.categoricals})
        staged, _ = _numeric_prepare(staged, self.numeric)
        return self.indexer.transform(staged)

    def predict(self, df: DataFrame, target: str = TARGET) -> DataFrame:
        """The input rows with ``target`` replaced by the prediction."""
        scored = self.model.transform(self.prepare(df))
        return scored.select(*[F.col("prediction").alias(target) if c == target else F.col(c) for c in df.columns])

    def save(self, path: str) -> None:
        """ACTION: indexer, model and one row of column lists and validation results under ``path``."""
        self.indexer.write().overwrite().save(f"{path}/indexer")
        self.model.write().overwrite().save(f"{path}/model")
        about = (self.categoricals, self.numeric, self.validation_mae, self.best_round, self.validation_errors)
        spark = SparkSession.active()
        spark.createDataFrame([about], _ABOUT).coalesce(1).write.mode("overwrite").parquet(f"{path}/about")

    @classmethod
    def load(cls, path: str) -> Forecaster:
        """ACTION: a saved forecaster, complete with its column lists."""
        about = SparkSession.active().read.parquet(f"{path}/about").first()
        return cls(PipelineModel.load(f"{path}/indexer"), PipelineModel.load(f"{path}/model"),
                   about["categoricals"], about["numeric"], about["validation_mae"], about["best_round"],
                   about["validation_errors"])


_ABOUT = ("categoricals array<string>, numeric array<string>, validation_mae double, best_round int, "
          "validation_errors array<double>")


def index_labels(df: DataFrame, cats: Sequence[str]) -> StringIndexerModel:
    """ACTION: codes of the labels of each column, from 0 in ascending order; unseen and NULL labels share the next code."""
    return StringIndexer(inputCols=list(cats), outputCols=[f"{c}__idx" for c in cats], handleInvalid="keep",
                         stringOrderType="alphabetAsc").fit(df.withColumns({c: F.col(c).cast("string") for c in cats}))


def label_dictionary(df: DataFrame, cats: Sequence[str]) -> DataFrame:
    """ACTION. ``column, label, code``: the distinct labels of each column, coded from 0 in ascending order; NULL is no label.

    No label reaches the driver and no column meets in one task: distinct labels are dealt to ranges of (column, label), checkpointed
    (range bounds are sampled, so they are drawn once), numbered inside their range, and moved by the counts of the ranges before."""
    ensure_checkpoint_dir(df.sparkSession)
    if not cats:
        return df.sparkSession.createDataFrame([], "column string, label string, code int")
    found = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("label")) for c in cats]))
    pairs = df.select(found.alias("p")).select("p.*").filter("label is not null").distinct()
    dealt = pairs.repartitionByRange("column", "label").withColumn("part", F.spark_partition_id()).checkpoint()
    counts = dealt.groupBy("column", "part").agg(F.count("*").alias("n"))  # a row per range and column
    before = counts.select("column", "part", (F.sum("n").over(Window.partitionBy("column").orderBy("part")) - F.col("n")).alias("before"))
    place = F.row_number().over(Window.partitionBy("column", "part").orderBy("label"))
    return dealt.withColumn("place", place).join(before, ["column", "part"]) \
        .select("column", "label", (F.col("before") + F.col("place") - 1).cast("int").alias("code"))


def encode_labels(df: DataFrame, dictionary: DataFrame, cats: Sequence[str]) -> DataFrame:
    """ACTION (one count per column). ``df`` with ``{c}_code`` for each column, joined from ``label_dictionary``; NULL and
    unseen labels share the code after the last. A column of that name is replaced; Spark broadcasts a dictionary by its size."""
    sizes = {r["column"]: r["n"] for r in dictionary.groupBy("column").agg(F.count("*").alias("n")).collect()}  # a row per column
    kept = [c for c in df.columns if c.lower() not in {f"{c}_code".lower() for c in cats}]
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))
    for i, c in enumerate(cats):
        one = dictionary.filter(F.col("column") == c).select(F.col("label").alias(f"label{i}"), F.col("code").alias(f"code{i}"))
        rows = rows.join(one, F.col(f"row.`{c}`").cast("string") == F.col(f"label{i}"), "left") \
            .withColumn(f"code{i}", F.coalesce(f"code{i}", F.lit(sizes.get(c, 0)))).drop(f"label{i}")
    return rows.select(*[F.col(f"row.`{c}`").alias(c) for c in kept], *[F.col(f"code{i}").alias(f"{c}_code") for i, c in enumerate(cats)])


def category_codes(df: DataFrame, cats: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """ACTION (labels are ranked). ``keys`` and the code of each categorical column, ``{c}_code``."""
    return encode_labels(df, label_dictionary(df, cats), cats).select(*[F.col(f"`{k}`") for k in keys], *[f"`{c}_code`" for c in cats])


def train_forecaster(
    df: DataFrame, categoricals: Sequence[str], cutoff: str | None = None, max_iter: int = 1000,
    step_size: float = 0.03, max_depth: int = 8, subsampling_rate: float = 1.0, feature_subset: str = "0.8",
    seed: int = 42, target: str = TARGET, ts: str = "timestamp_utc", patience: int = 100,
    ordinal: Sequence[str] = (),
) -> Forecaster:
    """Fit on rows with a known target for ``max_iter`` rounds (each costs about one Spark job per tree level).

    With ``cutoff`` a first model is fitted on the rows before it and judged by mean absolute error on the rows from
    it on, after every round and in one pass; ``stop_round`` with ``patience`` gives the round and error reported.
    The returned model is fitted on all rows and all rounds.
    Categoricals named in ``ordinal`` enter as ordered codes, all others as nominal features, whatever their number
    of labels: ``maxBins`` is the largest nominal number of labels, so name columns of very many labels there."""
    ensure_checkpoint_dir(df.sparkSession)
    labelled = df.filter(F.col(target).isNotNull() & ~F.isnan(F.col(target)))
    cats = [c for c in categoricals if c in df.columns]
    numeric = [c for c in feature_columns(df, target, ts) if c not in cats
               and isinstance(df.schema[c].dataType, (NumericType, BooleanType))]
    staged = labelled.withColumns({c: F.col(c).cast("string") for c in cats})
    staged, num_cols = _numeric_prepare(staged, numeric)
    # iterative fits re-read their input: keep it (recomputable from lineage if blocks are lost)
    staged = staged.persist(StorageLevel.MEMORY_AND_DISK)
    indexer = PipelineModel(stages=[index_labels(staged, cats)] if cats else [])
    labels = dict(zip(cats, indexer.stages[0].labelsArray)) if cats else {}
    coded = [c for c in cats if c in ordinal]
    arity = max([len(labels[c]) + 1 for c in cats if c not in coded] or [2])
    indexed = indexer.transform(staged)
    # a cast drops the nominal metadata: the code becomes an ordered numeric feature
    as_number = [SQLTransformer(statement="SELECT *, " + ", ".join(
        f"CAST(`{c}__idx` AS DOUBLE) AS `{c}__ord`" for c in coded) + " FROM __THIS__")] if coded else []
    inputs = [f"{c}__idx" for c in cats if c not in coded] + [f"{c}__ord" for c in coded] + num_cols
    assembler = PipelineModel(stages=[*as_number, VectorAssembler(inputCols=inputs, outputCol="features")])
    # checkpointInterval: boosting state is checkpointed to spark.checkpoint.dir every 10 rounds,
    # so a lost executor does not replay the whole iteration lineage
    gbt = GBTRegressor(featuresCol="features", labelCol=target, maxIter=max_iter, stepSize=step_size,
                       maxDepth=max_depth, subsamplingRate=subsampling_rate, featureSubsetStrategy=feature_subset,
                       seed=seed, maxBins=max(32, arity), lossType="squared", checkpointInterval=10, cacheNodeIds=True)

    errors, best, mae = [], None, None
    if cutoff is not None:
        later = F.col(ts) >= F.lit(cutoff).cast(df.schema[ts].dataType)
        early, valid = indexed.filter(~later), indexed.filter(later)
        if not early.isEmpty() and not valid.isEmpty():
            judged = gbt.fit(assembler.transform(early))
            errors = [float(e) for e in judged.evaluateEachIteration(assembler.transform(valid), "absolute")]
            best = stop_round(errors, patience)
            mae = errors[best - 1]
    final = gbt.fit(assembler.transform(indexed))
    staged.unpersist()
    return Forecaster(indexer, PipelineModel(stages=[*assembler.stages, final]), cats, numeric, mae, best, errors)
