"""Human review and side-by-side comparison: last decision wins, items by state, one column per model.

Samples are not deduplicated, decisions and predictions are (the last one counts). Null ids match nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from pathlib import PurePosixPath

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from .ranks import last_wins

MODES = ("pending", "approved", "rejected", "compare", "all")


def decisions(log: DataFrame, order: Sequence[str] = ("updated_at",)) -> DataFrame:
    """One row per id, the last decision; only approved and rejected are decisions."""
    return last_wins(log.where(F.col("decision").isin("approved", "rejected") & F.col("id").isNotNull()), ["id"], list(order))


def predictions(log: DataFrame, key: str, label: str, text: str, order: Sequence[str]) -> DataFrame:
    """(id, label, prediction) with the last prediction of each model; a missing text is ''."""
    p = log.select(F.col(key).alias("id"), F.col(label).alias("label"), F.coalesce(F.col(text), F.lit("")).alias("prediction"), *order)
    return last_wins(p.where("id is not null"), ["id", "label"], list(order)).select("id", "label", "prediction")


def items(samples: DataFrame, decided: DataFrame, predicted: DataFrame, mode: str = "all") -> DataFrame:
    """The samples of a mode; an unknown mode behaves as all."""
    if mode == "pending":
        return samples.join(decided.select("id"), "id", "left_anti")
    if mode in ("approved", "rejected"):
        return samples.join(decided.where(F.col("decision") == mode).select("id"), "id", "left_semi")
    if mode == "compare":
        return samples.join(predicted.select("id"), "id", "left_semi")
    return samples


def with_review(samples: DataFrame, decided: DataFrame) -> DataFrame:
    return samples.join(decided, "id", "left")


def compare(samples: DataFrame, predicted: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Samples with one column per model in the given order; null where a model has no prediction."""
    wide = predicted.groupBy("id").pivot("label", list(labels)).agg(F.first("prediction"))
    return samples.join(wide, "id", "left")


def summary(samples: DataFrame, decided: DataFrame, predicted: DataFrame) -> DataFrame:
    """total, reviewed (decisions without a sample included), approved, rejected, with_prediction."""
    have = samples.join(predicted.select("id"), "id", "left_semi")
    d = decided.agg(F.count(F.lit(1)).alias("reviewed"), F.count_if(F.col("decision") == "approved").alias("approved"), F.count_if(F.col("decision") == "rejected").alias("rejected"))
    return d.select(samples.agg(F.count(F.lit(1))).scalar().alias("total"), "reviewed", "approved", "rejected", have.agg(F.count(F.lit(1))).scalar().alias("with_prediction"))


def approved(rows: DataFrame, decided: DataFrame, key: str = "id") -> DataFrame:
    """The rows whose last decision is an approval, whole and with their columns."""
    return rows.join(decided.where("decision = 'approved'").select(F.col("id").alias(key)), key, "left_semi")


def exact_match(df: DataFrame, run: str, prediction: str, reference: str) -> DataFrame:
    """Per run: rows and predictions that are the reference but for outer white space."""
    hit = T.strip(F.col(prediction)) == T.strip(F.col(reference))
    return df.groupBy(run).agg(F.count(F.lit(1)).alias("cnt"), F.count_if(hit).alias("hits"))


def parse_predictions(specs: Sequence[str] | None) -> list[tuple[str, str]]:
    """'label=path' or 'path' (the file's stem is the label), in order."""
    out = []
    for s in specs or []:
        label, eq, path = s.partition("=")
        out.append((label.strip(), path.strip()) if eq else (PurePosixPath(s).stem, s.strip()))
    return out
