"""Agreement and calibration, with null where a denominator is zero."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Confidence bands by lower bound; gates as whole numbers of a hundred, and the fewest titles they count.
BANDS = (("0.95-1.00", 0.95), ("0.90-0.94", 0.90), ("0.80-0.89", 0.80), ("0.70-0.79", 0.70), ("0.50-0.69", 0.50), ("<0.50", float("-inf")))
OVERALL, SHOWN, HUMAN_MARGIN, LEAST_DOUBLE, LEAST_SHOWN, LEAST_SCORED, COVERAGE = 85, 95, 5, 20, 30, 80, 95


def ratio(a: Column, b: Column) -> Column:
    return a / F.nullif(b, F.lit(0))


def kappa(pairs: DataFrame, a: str, b: str, *by: str) -> DataFrame:
    """Cohen's kappa by group from two label columns: whole counts until the last division; null where chance agreement is 1."""
    cells = pairs.groupBy(*by, a, b).agg(F.count("*").alias("c"))
    both = cells.groupBy(*by).agg(F.sum("c").alias("n"), F.sum(F.when(F.col(a) == F.col(b), F.col("c")).otherwise(0)).alias("same"))
    one, two = (cells.groupBy(*by, F.col(x).alias("label")).agg(F.sum("c").alias(f"m_{k}")) for k, x in (("a", a), ("b", b)))
    chance = one.join(two, [*by, "label"]).groupBy(*by).agg(F.sum(F.col("m_a") * F.col("m_b")).alias("m"))
    out = both.join(chance, list(by), "left") if by else both.join(F.broadcast(chance), F.lit(True), "left")  # one row
    n, m = F.col("n"), F.coalesce("m", F.lit(0))
    return out.select(*by, "n", "same", F.when(n * n != m, (F.col("same") * n - m) / (n * n - m)).alias("kappa"))


def confusion(pairs: DataFrame, gold: Column, model: Column, *by: str) -> DataFrame:
    """Counts and ratios of a binary judgement by group."""
    c = pairs.groupBy(*by).agg(F.count_if(gold & model).alias("tp"), F.count_if(~gold & model).alias("fp"), F.count_if(gold & ~model).alias("fn"), F.count_if(~gold & ~model).alias("tn"))
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    c = c.withColumn("precision", ratio(tp, tp + fp)).withColumn("recall", ratio(tp, tp + fn)).withColumn("accuracy", ratio(tp + tn, tp + fp + fn + tn))
    p, r = F.col("precision"), F.col("recall")
    return c.withColumn("f1", F.when(p + r > 0, 2 * p * r / (p + r)))


def calibration(scored: DataFrame, confidence: str, correct: str) -> DataFrame:
    """All bands with n, correct and accuracy; empty ones too."""
    band = F.coalesce(*[F.when(F.col(confidence) >= low, F.lit(name)) for name, low in BANDS])
    got = scored.groupBy(band.alias("band")).agg(F.count("*").alias("n"), F.count_if(correct).alias("correct"))
    every = scored.sparkSession.createDataFrame([(n,) for n, _ in BANDS], "band string")
    out = every.join(got, "band", "left").select("band", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("correct", F.lit(0)).alias("correct"))
    return out.withColumn("accuracy", ratio(F.col("correct"), F.col("n")))


def jaccard(a: Column, b: Column) -> Column:
    """Of two arrays as sets; two empty ones are alike."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / union)


def at_least(part: Column, whole: Column, hundredths: int) -> Column:
    """Whether part / whole reaches the target, exactly; nothing of nothing does not."""
    return (whole > 0) & (part * 100 >= whole * hundredths)
