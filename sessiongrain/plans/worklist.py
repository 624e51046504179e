"""Partitions of items for a model call that is tried again in halves: a work list of rows, round by round."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessiongrain.plans.judge import Judge
from sessiongrain.sources.byte_lines import shared_folder

MOST_DEPTH = 3
_ITEM = "struct<order:string,id:string,text:string>"


def subdivide(items: DataFrame, judge: Judge, system: str, part: str, order: str, id_col: str, text: str, most_depth: int = MOST_DEPTH) -> DataFrame:
    """(id, part, depth, answer, error): every item once, with its answer (JSON), or with what its last partition failed of.

    A partition's items go to the judge together, as a JSON list of (id, text) in order; its answer is {"items": {id: value}}. A call that
    raises fails its partition: the partition is split in halves (the first has the odd item), which are calls of the next
    round, until none fails, a partition has one item, or most_depth is reached. Each round's calls are written
    once, so a lost executor repeats no finished call. Items that an answer leaves out are failed items. Null
    partitions are one partition; partitions must be small enough for one prompt, as packing leaves them.
    """
    spark = items.sparkSession
    folder = f"{shared_folder(spark)}/sessiongrain/worklist-{uuid.uuid4().hex[:12]}"
    schema = f"part string, depth int, items array<{_ITEM}>, answer string, error string"

    def call(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for name, depth, held in zip(pdf["part"], pdf["depth"], pdf["items"], strict=True):
                asked = json.dumps([{"id": x["id"], "text": x["text"]} for x in held], ensure_ascii=False)
                try:
                    answer, error = json.dumps(judge(system, asked)[0], ensure_ascii=False, sort_keys=True), None
                except Exception as e:  # what a call fails of is a result
                    answer, error = None, f"{type(e).__name__}: {e}"
                out.append((name, depth, list(held), answer, error))
            yield pd.DataFrame(out, columns=["part", "depth", "items", "answer", "error"])

    # The order within a partition is that of its column: its place is kept, as a string that sorts alike.
    rows = items.select(F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.struct(F.col(order).alias("o"), F.col(id_col).cast("string").alias("id"), F.col(text).alias("text")).alias("x"))
    sorted_ = F.array_sort(F.collect_list("x"))
    held = F.transform(sorted_, lambda x, i: F.struct(F.lpad(i.cast("string"), 10, "0").alias("order"), x["id"].alias("id"), x["text"].alias("text")))
    work = rows.groupBy("part").agg(held.alias("items")).select("part", F.lit(0).alias("depth"), "items")
    done = None
    for depth in range(most_depth + 1):
        work.mapInPandas(call, schema).write.parquet(f"{folder}/{depth}")
        calls = spark.read.schema(schema).parquet(f"{folder}/{depth}")
        again = F.col("error").isNotNull() & (F.size("items") > 1) & F.lit(depth < most_depth)
        finished = calls.where(~again)
        done = finished if done is None else done.unionByName(finished)
        half = F.ceil(F.size("items") / 2).cast("int")
        halves = F.array(F.struct(F.concat("part", F.lit(".0")).alias("part"), F.slice("items", 1, half).alias("items")), F.struct(F.concat("part", F.lit(".1")).alias("part"), F.slice("items", half + 1, F.size("items")).alias("items")))
        failed = calls.where(again)
        if failed.isEmpty():
            break
        work = failed.select(F.explode(halves).alias("h"), (F.col("depth") + 1).alias("depth")).select("h.part", "depth", "h.items")
    flat = done.select("part", "depth", F.explode("items").alias("x"), "answer", "error")
    answers = F.try_variant_get(F.try_parse_json("answer"), "$.items", "map<string,variant>")
    own = F.to_json(F.element_at(answers, F.col("x.id")))
    return flat.select(F.col("x.id").alias("id"), "part", "depth", own.alias("answer"), F.when(F.col("error").isNotNull(), F.col("error")).when(own.isNull(), "not answered").alias("error"))
