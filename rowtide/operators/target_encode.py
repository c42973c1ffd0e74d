"""Target encoding without leaks: a row's category becomes the smoothed mean target of the other folds.

The totals of a (category, fold) are combined before the shuffle, so a hot category is one row
a task. What a row gets follows from the totals of its category less those of its own fold, so no row's target
has a part in its own value, nor in that of any row of its fold:

    (sum of the others + smoothing * their mean target) / (number of the others + smoothing)

the mean being that of all rows of the other folds, which is also what a category gets that is in no other
fold. Rows of no fold (``fold`` missing, or no such column) get the same over all folds. A missing category
is a category; rows without a target take no part in the totals.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.functions.text import name
from rowtide.operators.lookup import lookup
from rowtide.session import materialise

MAX_FOLDS = 10_000


def fit_target_encoding(train: DataFrame, columns: Sequence[str], target: str, smoothing: float = 20.0) -> DataFrame:
    """Table (feature, category, fold, value, uses); rows without a feature hold what a new category gets.

    Every category has a row for every fold and for none, so a table serves rows that training has not seen.
    """
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(name(c)).cast("string").alias("category")) for c in columns])
    labelled = train.filter(F.col(target).isNotNull()).select("fold", F.col(target).cast("double").alias("t"), F.explode(cells).alias("c"))
    totals = labelled.groupBy("c.feature", "c.category", "fold").agg(F.sum("t").alias("t"), F.count("*").alias("n"))
    totals = materialise(totals, "category-totals")
    # Each feature's totals are those of all rows; the folds are few, which is checked.
    of_folds = totals.filter(F.col("feature") == columns[0]).groupBy("fold").agg(F.sum("t").alias("t"), F.sum("n").alias("n"))
    folds = of_folds.filter("fold IS NOT NULL").limit(MAX_FOLDS + 1).collect()
    if len(folds) > MAX_FOLDS:
        raise ValueError(f"more than {MAX_FOLDS} folds")
    whole = of_folds.agg(F.sum("t").alias("t"), F.sum("n").alias("n")).first()
    all_t, all_n = whole["t"] or 0.0, whole["n"] or 0
    means = {None: (all_t / all_n if all_n else None)}
    for f in folds:
        means[f["fold"]] = (all_t - f["t"]) / (all_n - f["n"]) if all_n > f["n"] else None
    fold_kind = train.schema["fold"].dataType.simpleString()
    kind = f"struct<fold: {fold_kind}, mean: double>"
    every = F.array(*[F.struct(F.lit(k).alias("fold"), F.lit(m).alias("mean")).cast(kind) for k, m in means.items()])
    spread = totals.groupBy("feature", "category").agg(F.sum("t").alias("t"), F.sum("n").alias("n"))
    spread = spread.select("feature", "category", "t", "n", F.explode(every).alias("f")).select("feature", "category", "t", "n", "f.*")
    own = totals.filter("fold IS NOT NULL").select(*[F.col(c).alias(f"own_{c}") for c in totals.columns])
    same = [F.col(c).eqNullSafe(F.col(f"own_{c}")) for c in ("feature", "category", "fold")]
    joined = spread.join(own, same, "left")
    t = F.col("t") - F.coalesce("own_t", F.lit(0.0))
    n = F.col("n") - F.coalesce("own_n", F.lit(0))
    value = F.try_divide(t + F.lit(float(smoothing)) * F.col("mean"), n + F.lit(float(smoothing)))
    table = joined.select("feature", "category", "fold", F.coalesce(value, "mean").alias("value"), F.coalesce("own_n", "n").alias("uses"))
    none = [(None, None, k, m, 0) for k, m in means.items()]
    schema = f"feature string, category string, fold {fold_kind}, value double, uses bigint"
    return table.unionByName(train.sparkSession.createDataFrame(none, schema))


def encode_target(df: DataFrame, table: DataFrame, columns: Sequence[str], suffix: str = "_target") -> DataFrame:
    """Add ``{c}{suffix}`` for every column; ``table`` should be a stored table."""
    again = [c for c in columns if f"{c}{suffix}" in df.columns]
    if again:
        raise ValueError(f"duplicate output columns: {[c + suffix for c in again]}")
    kind = table.schema["fold"].dataType
    fold = F.col("fold").cast(kind) if "fold" in df.columns else F.lit(None).cast(kind)
    means = {r["fold"]: r["value"] for r in table.filter("feature IS NULL").collect()}
    known = F.create_map(*[F.lit(v) for k, m in means.items() if k is not None for v in (k, m)]) if len(means) > 1 else None
    new = F.lit(means.get(None)).cast("double")
    if known is not None:
        # A fold that training did not have is no fold.
        new = F.when(F.col("__fold").isNotNull() & F.map_contains_key(known, F.col("__fold")), known[F.col("__fold")]).otherwise(new)
        fold = F.when(F.map_contains_key(known, F.coalesce(fold, F.lit(next(k for k in means if k is not None)))), fold)
    kept = df.columns
    out = df.withColumn("__fold", fold)
    for c in columns:
        one = table.filter(F.col("feature") == c).select(
            F.col("category").alias("__category"), F.col("fold").alias("__fold"), F.col("value").alias("__value"), "uses", F.lit(True).alias("__known")
        )
        out = lookup(out.withColumn("__category", F.col(name(c)).cast("string")), one, ["__category", "__fold"], uses="uses")
        out = out.withColumn(f"{c}{suffix}", F.when(F.col("__known"), F.col("__value")).otherwise(new))
        out = out.drop("__category", "__value", "__known")
    return out.select(*[F.col(name(c)) for c in kept], *[F.col(name(f"{c}{suffix}")) for c in columns])
