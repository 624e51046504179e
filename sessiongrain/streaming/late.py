"""Late rows of a stream as a table of their own, and each key once among those in time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery


def _table(spark: SparkSession, path: str, name: str, schema: str) -> DataFrame:
    return spark.read.schema(f"{schema}, epoch long").parquet(f"{path}/{name}")


def on_time(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return _table(spark, path, "on_time", schema)


def late(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return _table(spark, path, "late", schema)


def write_split(events: DataFrame, path: str, checkpoint: str, keys: list[str], time: str = "ts", delay: str = "10 minutes") -> StreamingQuery:
    """Processes what is there: rows older than the watermark go to path/late, the others, each key once, to path/on_time.

    The watermark is the greatest time of all earlier micro-batches less `delay`, as the built-in one, which drops
    such rows unseen. Copies of a key are looked for in the batch and among the rows in time that are not older than the
    watermark; the one with the least time stays (then the least as JSON). Every micro-batch writes folders of its own (epoch=N) from what earlier
    ones wrote, its mark last, so a batch that runs again after a failure gives the same rows once. A null time
    is in time and moves no mark; null keys are equal. A row costs its batch and the horizon, not the whole table.
    """
    spark = events.sparkSession
    columns = events.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in events.schema.fields)
    empty = spark.createDataFrame([], events.schema)
    for name, df in (("on_time", empty), ("late", empty), ("marks", empty.select(F.col(time).alias("mark")))):
        df.write.mode("ignore").parquet(f"{path}/{name}/epoch=-1")
    mark_schema = f"mark {events.schema[time].dataType.simpleString()}"

    def apply(batch: DataFrame, epoch: int) -> None:
        session = batch.sparkSession
        earlier = F.col("epoch") < epoch
        bound = _table(session, path, "marks", mark_schema).where(earlier).agg((F.max("mark") - F.expr(f"INTERVAL {delay}")).alias("__bound"))
        bounded = lambda df: df.crossJoin(F.broadcast(bound))  # noqa: E731  one row
        is_late = F.coalesce(F.col(time) < F.col("__bound"), F.lit(False))
        rows = bounded(batch)
        rows.where(is_late).select(*columns).write.mode("overwrite").parquet(f"{path}/late/epoch={epoch}")
        row = F.struct(*columns)
        firsts = rows.where(~is_late).groupBy(*keys).agg(F.min_by(row, F.struct(time, F.to_json(row))).alias("__row")).select("__row.*")
        known = bounded(on_time(session, path, schema).where(earlier)).where(~is_late).select(*[F.col(k).alias(f"__{k}") for k in keys])
        same = [firsts[k].eqNullSafe(known[f"__{k}"]) for k in keys]
        firsts.join(known, same, "left_anti").write.mode("overwrite").parquet(f"{path}/on_time/epoch={epoch}")
        batch.agg(F.max(time).alias("mark")).write.mode("overwrite").parquet(f"{path}/marks/epoch={epoch}")

    return events.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
