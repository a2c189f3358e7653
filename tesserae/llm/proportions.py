"""Problem 1: samples that match target category proportions.

Method: acceptance probabilities from target-to-observed ratios, independent sampling with slight oversampling, exact
correction of the counts, and a report of the categories that cannot be served.

Defined results: null or blank categories belong to no target; repeated rows count each; an empty table gives no sample
rows and reports every target with a positive need; a sample never has more than sample_rows rows: where the minima of a
plan alone ask for more, they are scaled down and reported as short; where a category has too few rows, the others of
the plan fill up in proportion; ties in the hash order fall to the smaller id.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ranks import shuffle_key, shuffled_rank, unit
from .common import cut, fits, maybe_broadcast, narrow, strip

OVERSAMPLE = 1.05
SEED = 3407


def category(c: Column) -> Column:
    """Category names compared without case, outer white space and the difference of '-' and '_'."""
    return F.nullif(F.replace(F.lower(strip(narrow(c))), F.lit("-"), F.lit("_")), F.lit(""))


def need() -> Column:
    """Rows that a target asks for: the greater of min_rows and its rounded share (halves up)."""
    share = F.floor(F.coalesce(F.col("target_share"), F.lit(0.0)) * F.coalesce(F.col("sample_rows"), F.lit(0)) + F.lit(0.5) + F.lit(1e-9))
    return F.greatest(F.coalesce(F.col("min_rows"), F.lit(0)), share).cast("bigint")


def observed(rows: DataFrame, targets: DataFrame, type_col: str = "question_type", set_col: str = "source_dataset") -> DataFrame:
    """targets with category_key, need_rows and observed_rows; one pre-aggregating pass over rows."""
    counts = rows.select(category(F.col(type_col)).alias("_k"), F.col(set_col).alias("_s")).where("_k is not null").groupBy("_k", "_s").agg(F.count(F.lit(1)).alias("_n"))
    t = targets.select("plan_id", F.col("source_dataset").alias("plan_set"), "question_type", "target_share", "min_rows", "sample_rows")
    t = t.withColumn("category_key", category(F.col("question_type"))).withColumn("need_rows", need())
    hit = (F.col("category_key") == F.col("_k")) & (F.col("plan_set").isNull() | (F.col("plan_set") == F.col("_s")))
    return (
        t.join(counts, hit, "left")
        .groupBy(*t.columns)
        .agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("observed_rows"))
    )


def level(share: np.ndarray, low: np.ndarray, high: np.ndarray, n: int) -> np.ndarray:
    """Rows of each category, in fractions: shares of a common level, held between low and high, that add up to n if they can."""
    if low.sum() > n:
        return low * n / low.sum()
    part = np.where(share > 0, share, 1.0)
    points = np.unique(np.concatenate(([0.0], (low / part)[share > 0], (high / part)[share > 0])))
    at = lambda x: np.minimum(np.maximum(x * share, low), np.maximum(high, low))
    totals = np.array([at(x).sum() for x in points])
    i = int(np.flatnonzero(totals <= n + 1e-9)[-1])
    if i + 1 == len(points):
        return at(points[i])
    return at(points[i] + (n - totals[i]) * (points[i + 1] - points[i]) / (totals[i + 1] - totals[i]))


def _quotas(pdf: pd.DataFrame) -> pd.DataFrame:
    """Integral quotas of one plan by largest remainders, with the acceptance probability of each category's rows."""
    pdf = pdf.sort_values("category_key", kind="stable").reset_index(drop=True)
    share = pdf.target_share.fillna(0.0).clip(lower=0).to_numpy(float)
    seen = pdf.observed_rows.to_numpy(float)
    low = np.minimum(pdf.min_rows.fillna(0).clip(lower=0).to_numpy(float), seen)
    x = level(share, low, np.where(share > 0, seen, 0.0), int(max(0, pdf.sample_rows.fillna(0).max())))
    q = np.floor(x + 1e-9).astype(np.int64)
    order = sorted(range(len(pdf)), key=lambda i: (-round(x[i] - q[i], 6), i))
    q[order[: max(0, int(np.floor(x.sum() + 0.5)) - int(q.sum()))]] += 1
    pdf["quota"] = q
    pdf["accept"] = np.minimum(1.0, (q * OVERSAMPLE + 5 * np.sqrt(q) + 5) / np.maximum(seen, 1))
    pdf["missing_rows"] = (pdf.need_rows - pdf.observed_rows).clip(lower=0)
    pdf["short_rows"] = (pdf.need_rows - pdf.quota).clip(lower=0)
    return pdf[["plan_id", "plan_set", "question_type", "category_key", "observed_rows", "need_rows", "quota", "accept", "missing_rows", "short_rows"]]


def quotas(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """One row per target: the rows to draw, the probability with which a row is accepted, and what cannot be met.

    missing_rows: what the target asks for beyond the rows that there are; short_rows: beyond the rows that the plan can give
    it. A plan has one row a category, so groups stay small.
    """
    return observed(rows, targets).groupBy("plan_id").applyInPandas(
        _quotas, "plan_id bigint, plan_set string, question_type string, category_key string, observed_rows bigint, need_rows bigint, quota bigint, accept double, missing_rows bigint, short_rows bigint"
    )


def deficits(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """The targets that cannot be served: their rows are fewer than they need."""
    return quotas(rows, targets).where("missing_rows > 0")


def sample(rows: DataFrame, targets: DataFrame, id_col: str = "sft_id", type_col: str = "question_type", set_col: str = "source_dataset", seed: int = SEED) -> DataFrame:
    """(plan_id, question_type, id): exactly the quota of each plan and category.

    A row is accepted where its hash with the plan is below p = 1.05 * quota / observed plus five standard deviations. The
    surplus is cut by rank in the order of the same hash; if a category still came out short (improbable), its other rows are
    ranked with the accepted ones, so that the result does not depend on chance.
    """
    q = cut(quotas(rows, targets))
    plan = maybe_broadcast(q.where("quota > 0").select("plan_id", "plan_set", "question_type", "category_key", "quota", "accept"))
    slim = rows.select(F.col(id_col), category(F.col(type_col)).alias("_k"), F.col(set_col).alias("_s")).where("_k is not null")
    met = slim.join(plan, (F.col("_k") == F.col("category_key")) & (F.col("plan_set").isNull() | (F.col("plan_set") == F.col("_s"))))
    met = met.withColumn("_key", F.concat_ws("|", F.col("plan_id").cast("string"), F.col(id_col).cast("string")))
    met = met.select("plan_id", "question_type", id_col, "quota", "_key", (unit(shuffle_key(seed, F.col("_key"))) < F.col("accept")).alias("_in"))
    drawn = cut(met.where("_in"))
    full = drawn.groupBy("plan_id", "question_type").agg(F.count(F.lit(1)).alias("_n"))
    short = q.where("quota > 0").join(full, ["plan_id", "question_type"], "left").where("coalesce(_n, 0) < quota").select("plan_id", "question_type")
    if not fits(short, 0):
        drawn = drawn.unionByName(met.where("not _in").join(maybe_broadcast(short), ["plan_id", "question_type"], "left_semi"))
    return shuffled_rank(drawn, ["plan_id", "question_type"], "_key", seed, "_r").where("_r <= quota").select("plan_id", "question_type", id_col)
