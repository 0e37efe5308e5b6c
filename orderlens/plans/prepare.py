"""Model-input preparation: bins to one-hot, R-style label, assembled and scaled features,
and a deterministic train/validation split.

One ``Pipeline`` is fitted on the training side only and applied unchanged to every other
frame, so a value gets the same code and the same scale everywhere (the source refitted its
indexer, one-hot encoder and scaler on the hold-out).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import ElementwiseProduct, OneHotEncoder, RFormula, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.session import scratch_path

# The source's column names for the prepared inputs.
BIN_COLUMNS = ("name_length", "description_length", "nbr_photo")
BIN_INDEX = ("name_lengthInd", "prod_desInd", "nbr_photoInd")
BIN_DUMMIES = ("name_length_dum", "prod_desc_dum", "nbr_photo_dum")
ASSEMBLED = "numericalFeatures"
FEATURES = "scaleFeatures"
TRAIN_FRACTION = 70


def index_categories(cols: Sequence[str], out: Sequence[str]) -> StringIndexer:
    """Most frequent value -> 0, ties alphabetical; unseen values get their own index."""
    return StringIndexer(
        inputCols=list(cols), outputCols=list(out), stringOrderType="frequencyDesc", handleInvalid="keep"
    )


def label_ranks(df: DataFrame, col: str) -> DataFrame:
    """(label, n, rank): the non-null values of a column as text, most frequent first, ties by text, from 0.

    The order of ``StringIndexer`` without its list in the driver: the counted labels are dealt to
    ranges of (count, label), and a running sum over the ranges' sizes (one row for each) numbers them.
    """
    spark = df.sparkSession
    counts = df.groupBy(F.col(f"`{col}`").cast("string").alias("label")).agg(F.count("*").alias("n")).where("label is not null")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = counts.repartitionByRange(parts, F.desc("n"), F.asc("label")).withColumn("part", F.spark_partition_id())
    path = scratch_path(spark, "labels")
    dealt.write.parquet(path)  # the ranges' numbers stay as they are
    dealt = spark.read.schema(dealt.schema).parquet(path)
    before = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = dealt.groupBy("part").agg(F.count("*").alias("size")).select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("first"))
    place = F.row_number().over(Window.partitionBy("part").orderBy(F.desc("n"), F.asc("label")))
    return dealt.withColumn("place", place).join(first, "part").select("label", "n", (F.col("first") + F.col("place") - 1).alias("rank"))


def index_by_rank(df: DataFrame, col: str, out: str, ranks: DataFrame) -> DataFrame:
    """``df`` with the label's rank as a double; labels unknown to ``ranks``, and null, get the next number
    behind all. A label that holds many rows is split by the join's skew handling."""
    known = ranks.select(F.col("label").alias("_label"), F.col("rank").cast("double").alias(out))
    unseen = ranks.agg(F.count("*").cast("double").alias("n")).first()["n"]
    joined = df.join(known, F.col(f"`{col}`").cast("string") == F.col("_label"), "left").drop("_label")
    return joined.withColumn(out, F.coalesce(F.col(f"`{out}`"), F.lit(unseen)))


def one_hot(cols: Sequence[str], out: Sequence[str]) -> OneHotEncoder:
    """Index -> sparse 0/1 vector. With ``keep`` indexing, dropLast drops the unseen slot, so
    every known value has a slot and an unseen value is the zero vector."""
    return OneHotEncoder(inputCols=list(cols), outputCols=list(out), dropLast=True)


def assemble(features: Sequence[str], out: str = ASSEMBLED) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="error")


def scale(inp: str = ASSEMBLED, out: str = FEATURES) -> StandardScaler:
    """Divide by the sample standard deviation, no centring (sparse vectors stay sparse)."""
    return StandardScaler(inputCol=inp, outputCol=out, withStd=True, withMean=False)


def scale_by(deviations: Sequence[float | None], inp: str = ASSEMBLED, out: str = FEATURES) -> ElementwiseProduct:
    """``scale`` with deviations known already: no pass over the table. A constant becomes 0, as there."""
    factors = Vectors.dense([1.0 / d if d else 0.0 for d in deviations])
    return ElementwiseProduct(scalingVec=factors, inputCol=inp, outputCol=out)


def feature_pipeline(
    features: Sequence[str], bins: Sequence[str] = BIN_COLUMNS, deviations: Sequence[float | None] | None = None
) -> Pipeline:
    """Bins -> index -> one-hot; numeric features -> assembled -> scaled ``scaleFeatures``. As in
    the source, the bin vectors are produced but not part of the model input. Given the features'
    ``deviations``, the scaler needs no fit."""
    stages = []
    if bins:
        idx = [BIN_INDEX[BIN_COLUMNS.index(b)] if b in BIN_COLUMNS else f"{b}_idx" for b in bins]
        dums = [BIN_DUMMIES[BIN_COLUMNS.index(b)] if b in BIN_COLUMNS else f"{b}_dum" for b in bins]
        stages += [index_categories(bins, idx), one_hot(idx, dums)]
    stages += [assemble(features), scale() if deviations is None else scale_by(deviations)]
    return Pipeline(stages=stages)


def fit_prepare(
    train: DataFrame, features: Sequence[str], bins: Sequence[str] = BIN_COLUMNS, deviations: Sequence[float | None] | None = None
) -> PipelineModel:
    return feature_pipeline(features, bins, deviations).fit(train)


def rformula_label(df: DataFrame, label: str, drop: Sequence[str] = ("review_score", "order_id")) -> DataFrame:
    """``label ~ . - drop...``: adds ``features`` and ``label`` (absent label or dropped terms
    are tolerated, as on the hold-out side)."""
    formula = f"{label} ~ ." + "".join(f" - {d}" for d in drop)
    return RFormula(formula=formula).fit(df).transform(df)


def _hash_slice(key: str, start: int) -> Column:
    """32 bits of ``md5(key)`` as a non-negative integer."""
    hexits = F.substring(F.md5(F.col(key).cast("string")), start, 8)
    return F.conv(hexits, 16, 10).cast("long")


def split_flag(key: str = "order_id", fraction: int = TRAIN_FRACTION) -> Column:
    """True for the training share of keys: depends only on the key, not on partitioning."""
    return _hash_slice(key, 1) % 100 < fraction


def hash_split(df: DataFrame, key: str = "order_id", fraction: int = TRAIN_FRACTION) -> tuple[DataFrame, DataFrame]:
    flag = split_flag(key, fraction)
    return df.where(flag), df.where(~flag)


def noise_flag(key: str = "order_id", one_in: int = 8) -> Column:
    """True for one key in ``one_in``, from bits of the hash used by neither the split nor the folds."""
    return _hash_slice(key, 17) % one_in == 0


def key_fraction(key: str = "order_id") -> Column:
    """A number from 0 up to 1, in thousandths, from bits of the hash of its own."""
    return _hash_slice(key, 25) % 1000 / 1000


def with_folds(df: DataFrame, k: int, key: str = "order_id", name: str = "fold") -> DataFrame:
    """Cross-validation fold per key (0..k-1), from bits of the hash unused by the split."""
    return df.withColumn(name, (_hash_slice(key, 9) % k).cast("int"))
