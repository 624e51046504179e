"""The model-call boundary: one injected function, cached by request hash, everything around it deterministic."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: (system text, user text) -> (answer, metadata). Raised errors become failure rows, never lost rows.
Judge = Callable[[str, str], tuple[dict, dict]]


def echo_judge(system: str, user: str) -> tuple[dict, dict]:
    """A deterministic stand-in: says how long the request was."""
    return {"chars": len(user)}, {"model": "echo"}


def call_judge(requests: DataFrame, judge: Judge, system: str, id_col: str = "request_id", prompt: str = "prompt", attempts: int = 3, cache: DataFrame | None = None) -> DataFrame:
    """(id, answer JSON, error, attempts, cached): requests that the cache answers are not sent again."""
    keyed = requests.select(id_col, prompt, F.sha2(F.concat_ws("\x1f", F.lit(system), F.col(prompt)), 256).alias("request_hash"))
    kind = requests.schema[id_col].dataType.simpleString()
    hits = keyed.join(cache.select("request_hash", F.col("answer").alias("known")), "request_hash", "left") if cache is not None else keyed.withColumn("known", F.lit(None).cast("string"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for name, text, mark in zip(pdf[id_col], pdf[prompt], pdf["request_hash"], strict=True):
                answer, error, tries = None, None, 0
                while answer is None and tries < attempts:
                    tries += 1
                    try:
                        value, _ = judge(system, text)
                        answer, error = json.dumps(value, ensure_ascii=False, sort_keys=True), None
                    except Exception as e:  # noqa: BLE001  the caller's function may raise anything
                        error = f"{type(e).__name__}: {e}"[:500]
                out.append((name, mark, answer, error, tries, False))
            yield pd.DataFrame(out, columns=[id_col, "request_hash", "answer", "error", "attempts", "cached"])

    sent = hits.where("known is null").mapInPandas(run, f"{id_col} {kind}, request_hash string, answer string, error string, attempts int, cached boolean")
    known = hits.where("known is not null").select(id_col, "request_hash", F.col("known").alias("answer"), F.lit(None).cast("string").alias("error"), F.lit(0).alias("attempts"), F.lit(True).alias("cached"))
    return sent.unionByName(known)


def pending(requests: DataFrame, done: DataFrame, failed: DataFrame, key: str = "trace_id") -> DataFrame:
    """Requests without a result, those that failed before last."""
    open_ = requests.join(done.select(key).distinct(), key, "left_anti")
    return open_.join(failed.select(key).distinct().withColumn("is_retry", F.lit(True)), key, "left").withColumn("is_retry", F.coalesce("is_retry", F.lit(False))).orderBy("is_retry", key)
