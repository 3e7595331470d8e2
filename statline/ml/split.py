"""Deterministic splits, scaling, label encoding and CV folds.

Splits hash the row key instead of drawing random numbers: the assignment
is the same on every run, after any repartitioning or executor loss, and in
any engine that has ``md5`` (``randomSplit`` depends on partition layout).
The first eight hex digits of ``md5(seed | key)`` are uniform over
[0, 2³²), so comparing them with a hex threshold selects a fraction.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import SQLTransformer, StringIndexer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.rank import row_number_by
from ..session import saved


def key_hash(key: Sequence[str], seed: int = 42) -> Column:
    """First 8 hex digits of md5(seed|k1|k2…), lower case."""
    parts = [F.lit(str(seed))] + [F.col(k).cast("string") for k in key]
    return F.substring(F.md5(F.concat_ws("|", *parts)), 1, 8)


def hex_threshold(fraction: float) -> str:
    return f"{min(int(fraction * 2 ** 32), 2 ** 32 - 1):08x}"


def holdout_split(df: DataFrame, key: Sequence[str] = ("player_id", "season"),
                  test_fraction: float = 0.2, seed: int = 42, col: str = "is_test") -> DataFrame:
    """L4: flag a stable ``test_fraction`` of rows as the hold-out set."""
    return df.withColumn(col, key_hash(key, seed) < F.lit(hex_threshold(test_fraction)))


def stratified_split(df: DataFrame, label: str, key: Sequence[str] = ("player_id", "season"),
                     test_fraction: float = 0.2, seed: int = 42, col: str = "is_test") -> DataFrame:
    """In every class the first round(fraction · class size) rows by key hash are test.

    The cutoff row of a class is found by counting: rows by class and leading
    hash digits, twice, leave a bucket of about one in 16 million rows, in
    which the last few places are numbered. Test rows are then a plain
    comparison with their class's cutoff; nothing is sorted as a whole.
    """
    at = F.struct(F.col("__h"), *[F.col(k) for k in key])
    rows = saved(df.withColumn("__h", key_hash(key, seed)), "split-input")
    classes = rows.groupBy(F.col(label).alias("__class")).agg(
        F.round(F.count(F.lit(1)) * test_fraction).cast("long").alias("__k")).where("__k > 0")
    wanted = classes.withColumn("__prefix", F.lit(""))
    for digits in (3, 6):
        mine = F.col(label).eqNullSafe(F.col("__class")) & F.col("__h").startswith(F.col("__prefix"))
        counts = (rows.join(wanted.select("__class", "__prefix"), mine)
                  .groupBy("__class", F.substring("__h", 1, digits).alias("__b")).agg(F.count(F.lit(1)).alias("__n")))
        upto = F.sum("__n").over(Window.partitionBy("__class").orderBy("__b"))
        counts = counts.withColumn("__upto", upto).withColumnRenamed("__class", "__of")
        wanted = saved(wanted.join(counts, F.col("__class").eqNullSafe(F.col("__of")))
                       .where("__k <= __upto AND __k > __upto - __n")
                       .select("__class", (F.col("__k") - F.col("__upto") + F.col("__n")).alias("__k"),
                               F.col("__b").alias("__prefix")), "split-cutoffs")
    mine = F.col(label).eqNullSafe(F.col("__class")) & F.col("__h").startswith(F.col("__prefix"))
    place = F.row_number().over(Window.partitionBy("__class").orderBy(at))
    cutoffs = saved(rows.join(wanted, mine).withColumn("__place", place).where("__place = __k")
                    .select("__class", at.alias("__cut")), "split-cutoffs")
    out = rows.join(cutoffs, F.col(label).eqNullSafe(F.col("__class")), "left")
    return out.withColumn(col, F.coalesce(at <= F.col("__cut"), F.lit(False))).drop("__h", "__class", "__cut")


def stratified_split_folds(df: DataFrame, label: str, key: Sequence[str] = ("player_id", "season"),
                           test_fraction: float = 0.2, k: int = 5, seed: int = 42, written: bool = False) -> DataFrame:
    """L5 + L14 from ONE within-class ranking: the first round(fraction · n) rows of
    each class (by key hash) are the hold-out; the remaining rows are dealt
    round-robin into k folds, so every fold keeps the class shares too.

    ``written`` says that ``df`` is little work on a written table. The rows are written in order of class and hash; what
    is returned reads them, and lists what it reads as ``_reads``."""
    hashed = df.withColumn("__h", key_hash(key, seed))
    order = [F.col("__h").asc()] + [F.col(c).asc() for c in key]
    numbered = row_number_by(hashed, order, partition_by=(label,), name="__rn", size="__nc", written=written)
    out = numbered.withColumn("__nt", F.round(F.col("__nc") * test_fraction))
    out = (out.withColumn("is_test", F.col("__rn") <= F.col("__nt"))
           .withColumn("fold", F.when(F.col("is_test"), F.lit(-1))
                       .otherwise(F.pmod(F.col("__rn") - F.col("__nt") - 1, F.lit(k))).cast("int"))
           .drop("__h", "__rn", "__nc", "__nt"))
    out._reads = numbered._reads
    return out


def kfold_column(df: DataFrame, key: Sequence[str] = ("player_id", "season"), k: int = 5,
                 seed: int = 42, col: str = "fold") -> DataFrame:
    """L14 (regression): fold 0…k−1 from the key hash (equal-width hash ranges)."""
    h = key_hash(key, seed)
    fold = F.lit(0)
    for j in range(1, k):
        fold = fold + (h >= F.lit(hex_threshold(j / k))).cast("int")
    return df.withColumn(col, fold)


def stratified_fold_column(df: DataFrame, label: str, key: Sequence[str] = ("player_id", "season"),
                           k: int = 5, seed: int = 42, col: str = "fold") -> DataFrame:
    """L14 (classification): fold = (row number inside the class by key hash − 1) mod k."""
    hashed = df.withColumn("__h", key_hash(key, seed))
    order = [F.col("__h").asc()] + [F.col(c).asc() for c in key]
    numbered = row_number_by(hashed, order, partition_by=(label,), name="__rn")
    return numbered.withColumn(col, ((F.col("__rn") - 1) % k).cast("int")).drop("__h", "__rn")


# ---------------------------------------------------------------- L6 scaling

class ScalerParams(dict):
    """(mean, population std) by column; ``constant`` names the columns that do not vary."""

    constant: tuple[str, ...] = ()


def fit_standard_scaler(train: DataFrame, cols: Sequence[str]) -> ScalerParams:
    """L6 fit: mean and population std per column in one aggregation (one row to the driver).

    A column without variation is scaled by 1 and listed as constant.
    """
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"m_{c}"), F.stddev_pop(c).alias(f"s_{c}")]
    row = train.agg(*aggs).first()
    params = ScalerParams((c, (float(row[f"m_{c}"] or 0.0), float(row[f"s_{c}"] or 1.0))) for c in cols)
    params.constant = tuple(c for c in cols if not row[f"s_{c}"])
    return params


def scaler_expressions(params: dict[str, tuple[float, float]], suffix: str = "") -> list[str]:
    return [f"(`{c}` - ({m!r})) / ({s!r}) AS `{c}{suffix}`" for c, (m, s) in params.items()]


def scaler_transformer(params: dict[str, tuple[float, float]], suffix: str = "_z") -> SQLTransformer:
    """Fitted z-scaling as a serialisable pipeline stage (pure SQL expressions).

    Scaled columns are added as ``{col}{suffix}``; the inputs stay.
    """
    stmt = f"SELECT *, {', '.join(scaler_expressions(params, suffix))} FROM __THIS__"
    return SQLTransformer(statement=stmt)


def scale(train: DataFrame, test: DataFrame, cols: Sequence[str], suffix: str = "_z"):
    """Z-score both sets with statistics fitted on ``train`` (zero std → 1)."""
    t = scaler_transformer(fit_standard_scaler(train, cols), suffix)
    return t.transform(train), t.transform(test)


# ---------------------------------------------------------------- L7 labels

def label_indexer(label: str, out: str = "label") -> StringIndexer:
    """Alphabetical 0…k−1 codes (the fit collects only the distinct labels); training labels are never NULL."""
    return StringIndexer(inputCol=label, outputCol=out, stringOrderType="alphabetAsc",
                         handleInvalid="error")


def encode_labels(df: DataFrame, label: str, out: str = "label_index"):
    """Rows with a label and its code; rows without one are left out."""
    df = df.where(F.col(label).isNotNull())
    model = label_indexer(label, out).fit(df)
    return model.transform(df), model
