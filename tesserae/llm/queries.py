"""Queries of the training-data operators: name -> (spark, sf_dir) -> DataFrame, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import defects, leakage, overlap, packing, proportions, repetition, spam, splits, truncation
from .common import few_files, table

Query = Callable[[SparkSession, str], DataFrame]


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return proportions.deficits(table(spark, d, "sft"), table(spark, d, "sampling_targets")).select("plan_id", "question_type")


def p1_quotas(spark: SparkSession, d: str) -> DataFrame:
    return proportions.quotas(table(spark, d, "sft"), table(spark, d, "sampling_targets")).select("plan_id", "question_type", "observed_rows", "need_rows", "quota", "missing_rows", "short_rows")


def p1_sample(spark: SparkSession, d: str) -> DataFrame:
    return proportions.sample(table(spark, d, "sft"), table(spark, d, "sampling_targets"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    sft, pred = table(spark, d, "sft"), table(spark, d, "val_pred")
    return defects.found(defects.pairs_of(sft, pred), truncation.texts_of(sft, pred), truncation.corpus_of(sft, pred))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return splits.related_pairs(table(spark, d, "sft"), table(spark, d, "val"), table(spark, d, "manifest"))


def p3_scenes(spark: SparkSession, d: str) -> DataFrame:
    return splits.scenes(table(spark, d, "sft"), table(spark, d, "val"), table(spark, d, "manifest"))


def p3_split(spark: SparkSession, d: str) -> DataFrame:
    return splits.assign(table(spark, d, "sft"), table(spark, d, "val"), table(spark, d, "manifest"), table(spark, d, "split_targets"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    sft, pred = table(spark, d, "sft"), table(spark, d, "val_pred")
    return truncation.truncated(truncation.texts_of(sft, pred), truncation.corpus_of(sft, pred))


def p4_rates(spark: SparkSession, d: str) -> DataFrame:
    sft, pred = table(spark, d, "sft"), table(spark, d, "val_pred")
    return truncation.rates(truncation.texts_of(sft, pred), truncation.corpus_of(sft, pred))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return overlap.overlaps(table(spark, d, "sft"), table(spark, d, "val")).select("sft_id", "val_id")


def p5_report(spark: SparkSession, d: str) -> DataFrame:
    return overlap.report(table(spark, d, "sft"), table(spark, d, "val"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return repetition.found(table(spark, d, "sft"), "sft_id", "answer", parts=few_files(table(spark, d, "sft"))).select("sft_id")


def p6_share(spark: SparkSession, d: str) -> DataFrame:
    return repetition.measure(table(spark, d, "sft"), "sft_id", "answer", parts=few_files(table(spark, d, "sft")))


def p7_pack(spark: SparkSession, d: str) -> DataFrame:
    return packing.fill(table(spark, d, "documents"), table(spark, d, "pack_limits"), parts=few_files(table(spark, d, "documents")))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return leakage.leaks(table(spark, d, "documents"), table(spark, d, "eval_items"), parts=few_files(table(spark, d, "documents")))


def p8_report(spark: SparkSession, d: str) -> DataFrame:
    return leakage.report(p8_found(spark, d))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return spam.found(table(spark, d, "documents"), few_files(table(spark, d, "documents")))


def p9_hosts(spark: SparkSession, d: str) -> DataFrame:
    return spam.by_host(table(spark, d, "documents"), few_files(table(spark, d, "documents")))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        p1_found, p1_quotas, p1_sample, p2_found, p3_found, p3_scenes, p3_split, p4_found, p4_rates, p5_found, p5_report, p6_found, p6_share,
        p7_pack, p8_found, p8_report, p9_found, p9_hosts,
    )
}
