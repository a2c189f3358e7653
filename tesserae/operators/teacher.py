"""The boundary to a model: one client per partition, retries with backoff, failures as a column.

A TeacherFn takes (prompt, image, max_tokens, temperature) and returns text. There is no network here; stub() is a
deterministic stand-in. Anti joins on what is done belong before ask(): the optimizer does not know what a call costs.
Materialise the result of a stage before the next reads it, since a retried task asks again.
"""

from __future__ import annotations

import hashlib
import os
import random
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranks import numbered

TeacherFn = Callable[[str, str, int, float], str]
#: Statuses of a server that is only busy, and the limits of a stage (tokens, temperature).
OVERLOADED = frozenset({429, 502, 503, 504})
STAGE = {"describe": (2048, 0.3), "ask": (2048, 0.4), "answer": (2048, 0.3)}


def stub() -> TeacherFn:
    def call(prompt: str, image: str, max_tokens: int, temperature: float) -> str:
        return "stub-" + hashlib.md5(f"{image}|{prompt}".encode()).hexdigest()[:12]

    return call


def overloaded(e: Exception) -> bool:
    status = getattr(e, "status_code", None) or getattr(getattr(e, "response", None), "status_code", None)
    return isinstance(e, (TimeoutError, ConnectionError)) or status in OVERLOADED


def retry_after(e: Exception) -> float | None:
    """Seconds that the server asked to wait, if it did."""
    headers = getattr(getattr(e, "response", None), "headers", None) or {}
    try:
        return max(0.0, float(next(v for k, v in headers.items() if k.lower() == "retry-after")))
    except (StopIteration, TypeError, ValueError):
        return None


def patient(call: TeacherFn, retries: int = 3, base: float = 2.0, cap: float = 60.0, sleep: Callable[[float], None] = time.sleep) -> TeacherFn:
    """call with retries: an empty text is a failure, a busy server is waited for (its hint, or full jitter up to
    base * 2 ** attempt), other failures are tried again at once, and the last is raised. No retries at all gives ''."""

    def run(prompt: str, image: str, max_tokens: int, temperature: float) -> str:
        for attempt in range(retries):
            try:
                text = call(prompt, image, max_tokens, temperature)
                if text:
                    return text
                raise ValueError("empty response")
            except Exception as e:
                if attempt + 1 == retries:
                    raise
                if overloaded(e):
                    hint = retry_after(e)
                    sleep(min(cap, hint) if hint is not None else random.uniform(0, min(cap, base * 2**attempt)))
        return ""

    return run


def model_name(given: str | None, probe: Callable[[], str | None] = lambda: None, default: str = "stub") -> str:
    """The model to use: as given, or by the environment, or what the server says, or the default."""
    return given or os.environ.get("VLLM_MODEL") or probe() or default


def render(template: str, **cols: Column) -> Column:
    """A prompt from a template with {names}; null values count as ''."""
    out, rest = [], template
    while rest:
        hits = [(rest.find("{" + k + "}"), k) for k in cols if "{" + k + "}" in rest]
        if not hits:
            out.append(F.lit(rest))
            break
        at, k = min(hits)
        if at:
            out.append(F.lit(rest[:at]))
        out.append(F.coalesce(cols[k].cast("string"), F.lit("")))
        rest = rest[at + len(k) + 2 :]
    return F.concat(*out) if out else F.lit("")


def ask(
    df: DataFrame, prompt: Column, image: str, make: Callable[[], TeacherFn] = stub, stage: str = "answer", out: str = "response",
    in_flight: int = 24, retries: int = 3, only: Column | None = None, error: str = "error",
) -> DataFrame:
    """df with the response and `error` (null if it went well).

    Each task has one client with retries and a pool of threads, since a call waits for a server; in_flight bounds the calls
    of all cores together. Rows for which `only` does not hold are not asked about: response and error stay null. Two
    calls may be chained without a barrier: a row goes on to the second as soon as its batch has passed the first.
    """
    tokens, temperature = STAGE[stage]
    cores = df.sparkSession.sparkContext.defaultParallelism
    d = df.withColumn("_prompt", F.when(only, prompt) if only is not None else F.coalesce(prompt, F.lit("")))
    d = d.repartition(in_flight) if 0 < in_flight < cores else d
    threads = max(1, in_flight // cores)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        call = patient(make(), retries)

        def one(row: tuple) -> tuple[str | None, str | None]:
            if row[0] is None:
                return None, None
            try:
                return call(row[0], row[1], tokens, temperature), None
            except Exception as e:
                return None, f"{type(e).__name__}: {e}"

        with ThreadPoolExecutor(threads) as pool:
            for pdf in parts:
                rows = list(zip(pdf["_prompt"].astype(object).where(pdf["_prompt"].notna(), None), pdf[image]))
                said = list(pool.map(one, rows) if threads > 1 else map(one, rows))
                yield pdf.drop(columns="_prompt").assign(**{out: pd.Series([x for x, _ in said], dtype=object, index=pdf.index), error: pd.Series([e for _, e in said], dtype=object, index=pdf.index)})

    return d.mapInPandas(run, f"{fields}, `{out}` string, `{error}` string")


def split_errors(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows, and the counts of good and failed rows."""
    return df.where("error is null").drop("error"), df.agg(F.count_if(F.col("error").isNull()).alias("ok"), F.count_if(F.col("error").isNotNull()).alias("err"))


def reward(c: Column) -> Column:
    """The number after the first 'Reward:' (up to a second one), stars dropped; 0 where there is none; never clamped."""
    text = F.try_element_at(F.split(c, "Reward:"), F.lit(2))
    number = F.replace(F.btrim(text, F.lit(" \t\n\r\f\x0b　")), F.lit("*"), F.lit(""))
    plain = number.rlike(r"^\s*[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?\s*$")
    return F.coalesce(F.when(plain, number.try_cast("double")), F.lit(0.0))


def reward_query(template: str, messages: Column, truth: Column) -> Column:
    """A reward model's query: earlier turns without a leading system turn as JSON, the truth, and the last turn's text."""
    n = F.size(messages)
    before = F.slice(messages, 1, F.greatest(n - 1, F.lit(0)))
    before = F.when(F.get(before, F.lit(0))["role"] == "system", F.slice(before, 2, F.greatest(n, F.lit(1)))).otherwise(before)
    q = F.replace(F.lit(template), F.lit("#query#"), F.to_json(before))
    q = F.replace(q, F.lit("#ground_truth#"), truth)
    return F.replace(q, F.lit("#response#"), F.element_at(messages, -1)["content"])


def by_position(requests: DataFrame, truths: DataFrame, order: str, truth: str) -> DataFrame:
    """Requests with the truth at the same place of the other table's order; what the longer one has more is left out.

    Places are running numbers over the table's order, made from the counts of range partitions, so no task sorts a whole table.
    """
    a, b = numbered(requests, order, "_place"), numbered(truths.select(order, truth), order, "_place").drop(order)
    return a.join(b, "_place").drop("_place")
