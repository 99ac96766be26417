"""Error forensics.

Class centroids are one grouped aggregate (k classes x p features, bounded)
and are inlined as literal arrays, so the nearest-centroid search (J4) is a
per-row array expression - no join with the centroid table and no
cartesian product.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..schema import BENIGN


def error_rows(scored: DataFrame, y: str, pred: str, model: str | None = None) -> DataFrame:
    """false positives and false negatives of a binary model."""
    t = (F.when((F.col(y) == 0) & (F.col(pred) == 1), "FP")
          .when((F.col(y) == 1) & (F.col(pred) == 0), "FN"))
    out = scored.withColumn("error_type", t).where(F.col("error_type").isNotNull())
    return out.withColumn("model", F.lit(model)) if model else out


def error_summary(scored: DataFrame, y: str, pred: str, by=()) -> DataFrame:
    """F1 (counts): FP, FN and their percent of the test rows."""
    fp = F.count_if((F.col(y) == 0) & (F.col(pred) == 1))
    fn = F.count_if((F.col(y) == 1) & (F.col(pred) == 0))
    n = F.count(F.lit(1))
    agg = [fp.alias("fp"), fn.alias("fn"), n.alias("n"),
           (fp * 100.0 / n).alias("fp_pct"), (fn * 100.0 / n).alias("fn_pct")]
    return scored.groupBy(*by).agg(*agg) if by else scored.agg(*agg)


def misclassified(scored: DataFrame, y: str = "y_true", pred: str = "y_pred") -> DataFrame:
    """multiclass rows with a wrong prediction."""
    return scored.where(F.col(y) != F.col(pred))


def fn_by_class(scored: DataFrame, y: str = "y_true", pred: str = "y_pred", benign: str = BENIGN) -> DataFrame:
    """per attack class, rows predicted benign (missed) and the total."""
    return (scored.where(F.col(y) != F.lit(benign)).groupBy(y)
                  .agg(F.count_if(F.col(pred) == F.lit(benign)).alias("fn"), F.count(F.lit(1)).alias("total")))


def centroids(df: DataFrame, features, label: str) -> DataFrame:
    """Mean vector per class (long form: label, feature, mean)."""
    features = list(features)
    g = df.groupBy(label).agg(*[F.avg(c).alias(c) for c in features])
    return g.unpivot([label], features, "feature", "mean")


def centroid_map(df: DataFrame, features, label: str, max_classes: int = 10_000) -> dict:
    """Centroids collected as {class: [means]} (classes x features numbers, checked)."""
    features = list(features)
    rows = df.groupBy(label).agg(*[F.avg(c).alias(c) for c in features]).limit(max_classes + 1).collect()
    if len(rows) > max_classes:
        raise ValueError("too many classes for centroids")
    return {r[label]: [r[c] for c in features] for r in rows}


def distance_to(features, center) -> Column:
    """Euclidean distance of the row's features to a literal point."""
    acc = None
    for c, m in zip(features, center):
        d = (F.col(c) - F.lit(float(m))) * (F.col(c) - F.lit(float(m)))
        acc = d if acc is None else acc + d
    return F.sqrt(acc)


def nearest_centroid(df: DataFrame, features, cents: dict, out_class: str = "closest_class",
                     out_dist: str = "closest_distance") -> DataFrame:
    """The closest centroid (ties: smallest class) and its distance."""
    structs = [F.struct(distance_to(features, v).alias("d"), F.lit(k).alias("k")) for k, v in sorted(cents.items())]
    best = F.array_min(F.array(*structs))
    return df.withColumn("_best", best).withColumn(out_class, F.col("_best.k")) \
             .withColumn(out_dist, F.col("_best.d")).drop("_best")


def fn_analysis(scored: DataFrame, train: DataFrame, features, label: str, day: str,
                raw_cols=("total_fwd_packets", "flow_duration"), rare_below: int = 100,
                benign: str = BENIGN) -> DataFrame:
    """missed attacks with type, day, probability, distance to the benign
    centroid (of the training rows), rare-in-training flag and raw features."""
    ben = centroid_map(train.where(F.col(label) == benign), features, label)[benign]
    counts = {r[0]: r[1] for r in train.groupBy(label).count().limit(10_001).collect()}
    if len(counts) > 10_000:
        raise ValueError("too many classes for the rare-class flag")
    rare = F.create_map(*[x for k, v in counts.items() for x in (F.lit(k), F.lit(v < rare_below))])
    fn = scored.where((F.col("y") == 1) & (F.col("pred") == 0))
    return fn.select(
        F.col(label).alias("attack_type"), F.col(day).alias("day"), F.round("score", 4).alias("probability"),
        F.round(distance_to(features, ben), 2).alias("distance_to_benign"),
        F.when(F.coalesce(rare[F.col(label)], F.lit(True)), "Yes").otherwise("No").alias("rare_in_training"),
        *[F.col(f"raw_{c}").alias(f"raw_{c}") for c in raw_cols], "row_id")


def fp_analysis(scored: DataFrame, train: DataFrame, features, label: str, day: str,
                raw_cols=("total_fwd_packets", "flow_duration"), benign: str = BENIGN) -> DataFrame:
    """false alarms with day, probability, closest attack centroid and distance."""
    cents = {k: v for k, v in centroid_map(train.where(F.col(label) != benign), features, label).items()}
    fp = scored.where((F.col("y") == 0) & (F.col("pred") == 1))
    nc = nearest_centroid(fp, features, cents)
    return nc.select(F.col(day).alias("day"), F.round("score", 4).alias("probability"),
                     F.col("closest_class").alias("closest_attack"),
                     F.round("closest_distance", 2).alias("distance_to_attack"),
                     *[F.col(f"raw_{c}").alias(f"raw_{c}") for c in raw_cols], "row_id")


def worst_model(errors: DataFrame) -> DataFrame:
    """the model with the most errors (ties: name)."""
    g = errors.groupBy("model").agg(F.count(F.lit(1)).alias("n_errors"))
    return g.orderBy(F.col("n_errors").desc(), "model").limit(1)


def cohort_means(errors: DataFrame, features) -> DataFrame:
    """mean feature values of each error cohort."""
    return errors.groupBy("error_type").agg(*[F.avg(c).alias(c) for c in features])


def cohorts(scored: DataFrame, y: str = "y", pred: str = "pred", key: str = "row_id") -> DataFrame:
    """F8: tp/tn/fp/fn cohort sizes and the first row (smallest key) of each."""
    c = (F.when((F.col(y) == 1) & (F.col(pred) == 1), "tp").when((F.col(y) == 0) & (F.col(pred) == 0), "tn")
          .when((F.col(y) == 0) & (F.col(pred) == 1), "fp").otherwise("fn"))
    return scored.withColumn("cohort", c).groupBy("cohort").agg(
        F.count(F.lit(1)).alias("n"), F.min(key).alias("first_" + key))
