"""Counts, shares, pivots, incidence, top-k, samples, de-duplication and comparison."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sessiongrain.functions.scalars import label_key


def counts(rows: DataFrame, column: str) -> DataFrame:
    return rows.groupBy(column).agg(F.count("*").alias("n"))


def counts_of_elements(rows: DataFrame, column: str, into: str) -> DataFrame:
    """Counts over an array column; empty and null arrays count as 'unknown'."""
    filled = F.when(F.size(F.coalesce(column, F.array().cast("array<string>"))) == 0, F.array(F.lit("unknown"))).otherwise(F.col(column))
    return counts(rows.select(F.explode(filled).alias(into)), into)


def distribution(rows: DataFrame, label: str, member: str, order: str, trace: str | None = None, members: bool = False) -> DataFrame:
    """Groups of labels equal but for case and white space: the first label seen, members, traces, share of all rows.

    members adds the sorted member ids; a hot label then holds as many ids as it has rows, so it is optional.
    """
    labelled = rows.where(F.trim(label) != "")
    aggregates = [F.min_by(F.trim(label), order).alias("label"), F.count("*").alias("n"), F.count_distinct(trace or member).alias("n_traces")]
    if members:
        aggregates.append(F.array_sort(F.collect_set(member)).alias("members"))
    grouped = labelled.groupBy(label_key(F.col(label)).alias("label_key")).agg(*aggregates)
    total = labelled.agg(F.count("*").alias("total"))
    return grouped.crossJoin(F.broadcast(total)).withColumn("share", F.bround(F.col("n") / F.col("total"), 4)).drop("total")


def status_rollup(rows: DataFrame, key: list[str], status: str, ranked: tuple[str, ...]) -> DataFrame:
    """One status per key: the first of `ranked` that any row has, else the last of them."""
    flags = [F.bool_or(F.col(status) == s).alias(f"has_{i}") for i, s in enumerate(ranked[:-1])]
    out = None
    for i, s in enumerate(ranked[:-1]):
        out = F.when(F.col(f"has_{i}"), s) if out is None else out.when(F.col(f"has_{i}"), s)
    return rows.groupBy(*key).agg(*flags).select(*key, out.otherwise(ranked[-1]).alias(status))


def pivot_counts(rows: DataFrame, key: str, column: str, values: list[str], distinct: str | None = None) -> DataFrame:
    """Counts of rows (or of distinct ids) for each key and value; absent pairs are 0."""
    cell = lambda v: F.count_distinct(F.when(F.col(column) == v, F.col(distinct))) if distinct else F.count(F.when(F.col(column) == v, 1))
    return rows.groupBy(key).agg(*[cell(v).alias(v) for v in values])


def configurations(rows: DataFrame, key: str, columns: list[str], flag: str) -> DataFrame:
    """Keys grouped by their sorted sets of `columns`: keys, rows and keys with a flagged row."""
    sets = rows.groupBy(key).agg(*[F.array_join(F.array_sort(F.collect_set(c)), ",").alias(c) for c in columns], F.count("*").alias("rows"), F.bool_or(flag).alias("flagged"))
    return sets.groupBy(*columns).agg(F.count("*").alias("n_keys"), F.sum("rows").alias("n_rows"), F.count(F.when(F.col("flagged"), 1)).alias("n_flagged"))


def incidence(dimension: DataFrame, facts: DataFrame, key: str, case: str, flag: Column) -> DataFrame:
    """Distinct cases, and distinct flagged cases, for every row of the dimension; those without facts stay, at 0."""
    found = facts.groupBy(key).agg(F.count_distinct(case).alias("n_cases"), F.count_distinct(F.when(flag, F.col(case))).alias("n_flagged"))
    return dimension.join(found, key, "left").fillna(0, ["n_cases", "n_flagged"])


def thresholds(rows: DataFrame, measure: str, levels: list[float]) -> DataFrame:
    """For each level the rows at or above it and their share."""
    table = rows.sparkSession.createDataFrame([(x,) for x in levels], "level double")
    summed = rows.agg(F.count("*").alias("total"), *[F.count(F.when(F.col(measure) >= x, 1)).alias(f"n{i}") for i, x in enumerate(levels)])
    picked = F.element_at(F.array(*[f"n{i}" for i in range(len(levels))]), F.array_position(F.array(*map(F.lit, levels)), F.col("level")).cast("int"))
    return table.crossJoin(F.broadcast(summed)).select("level", picked.alias("n"), F.bround(picked / F.nullif(F.col("total"), F.lit(0)), 4).alias("share"))


def orphaned(incidence_rows: DataFrame, label: str, case: str, low: DataFrame) -> DataFrame:
    """Cases all of whose labels are low."""
    marked = incidence_rows.join(low.select(label).withColumn("__low", F.lit(True)), label, "left")
    return marked.groupBy(case).agg(F.every(F.coalesce("__low", F.lit(False))).alias("all_low")).where("all_low").select(case)


def top_per_group(rows: DataFrame, key: list[str], order: list[Column], n: int) -> DataFrame:
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where(F.col("rank") <= n)


def hash_rank(column: str, salt: str) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(salt), F.col(column).cast("string")), 256)


def stratified_sample(rows: DataFrame, strata: list[str], id_col: str, size: int, salt: str = "pilot") -> DataFrame:
    """`size` rows: equal quotas for the strata by hash order, then the rest by hash order. A sampling operator."""
    ranked = rows.withColumn("__h", hash_rank(id_col, salt))
    n_strata = ranked.select(*strata).distinct().count()
    quota = size // n_strata if n_strata else 0
    own = ranked.withColumn("__r", F.row_number().over(Window.partitionBy(*strata).orderBy("__h", id_col)))
    return own.orderBy((F.col("__r") > quota).cast("int"), "__h", id_col).limit(size).drop("__h", "__r")


def spread_sample(rows: DataFrame, order: str, k: int) -> DataFrame:
    """k rows at even positions of the order: round half even of i * (n - 1) / (k - 1); the middle one for k = 1.

    Positions come from counts of hashed ranges, so no task sorts all rows.
    """
    n = rows.count()
    if n == 0 or k <= 0:
        return rows.limit(0)
    wanted = sorted({round(i * (n - 1) / (k - 1)) for i in range(k)} if k > 1 else {(n - 1) // 2})
    placed = global_position(rows, [order])
    return placed.where(F.col("position").isin(wanted)).drop("position")


def spread_places(n: int, k: int) -> list[int]:
    """k even places of n, both ends included: all if there are no more, the upper middle for one."""
    if k >= n:
        return list(range(n))
    if k <= 1:
        return [n // 2] if k == 1 else []
    return sorted({round(i * (n - 1) / (k - 1)) for i in range(k)})


def spread_by(rows: DataFrame, order: list[str], k: int) -> DataFrame:
    """k rows at even places of the order (see spread_places). A sampling operator; only k places reach the plan."""
    n = rows.count()
    if k >= n:
        return rows
    return global_position(rows, order).where(F.col("position").isin(spread_places(n, k))).drop("position")


def global_position(rows: DataFrame, order: list[str]) -> DataFrame:
    """rows with their place, from 0, in the total order: ranges are sorted in parallel, their sizes summed before them."""
    ranged = rows.repartitionByRange(*order).withColumn("__part", F.spark_partition_id())
    sizes = ranged.groupBy("__part").agg(F.count("*").alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select("__part", before.alias("__offset"))  # one row a partition
    inside = F.row_number().over(Window.partitionBy("__part").orderBy(*order)) - 1
    return ranged.withColumn("__i", inside).join(F.broadcast(offsets), "__part").withColumn("position", F.col("__offset") + F.col("__i")).drop("__part", "__i", "__offset")


def latest(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The row of each key with the greatest order values; by partial aggregation, without a sort."""
    best = rows.groupBy(*key).agg(F.max_by(F.struct(*rows.columns), F.struct(*order)).alias("__r"))
    return best.select("__r.*")


def version_conflicts(rows: DataFrame, key: list[str], content: list[str]) -> DataFrame:
    """Keys with more than one version: versions and copies."""
    version = F.sha2(F.to_json(F.struct(*content)), 256)
    return rows.groupBy(*key).agg(F.count_distinct(version).alias("n_versions"), F.count("*").alias("n_copies")).where("n_versions > 1")


def duplicate_groups(rows: DataFrame, same: list[str], rank: list[Column], id_col: str, labels: str | None = None) -> DataFrame:
    """Rows that agree in `same`: the winner by rank, the others' count, and labels on which copies disagree."""
    ranked = rows.withColumn("__w", F.row_number().over(Window.partitionBy(*same).orderBy(*rank)))
    out = [F.max(F.when(F.col("__w") == 1, F.col(id_col))).alias("winner"), F.count("*").alias("n")]
    if labels:
        out.append(F.array_sort(F.array_except(F.array_distinct(F.flatten(F.collect_set(labels))), F.aggregate(F.collect_set(labels), F.get(F.collect_set(labels), F.lit(0)), F.array_intersect))).alias("disputed"))
    return ranked.groupBy(*same).agg(*out).where("n > 1")


def compare(old: DataFrame, new: DataFrame, key: list[str], fields: list[str]) -> DataFrame:
    """Full outer difference: key and added, removed, changed or same."""
    mark = lambda df, n: df.select(*key, F.struct(*fields).alias(n))
    both = mark(old, "__a").join(mark(new, "__b"), key, "full_outer")
    return both.select(*key, F.when(F.col("__a").isNull(), "added").when(F.col("__b").isNull(), "removed").when(F.col("__a").eqNullSafe(F.col("__b")), "same").otherwise("changed").alias("change"))


def facets(rows: DataFrame, equal: dict[str, str], contains: dict[str, str], query: str, fields: list[str]) -> DataFrame:
    """AND of equal facets, array facets and a case-blind substring over the fields; empty values restrict nothing."""
    out = rows
    for c, v in equal.items():
        out = out.where(F.col(c) == v) if v else out
    for c, v in contains.items():
        out = out.where(F.array_contains(c, v)) if v else out
    return out.where(F.contains(F.lower(F.concat_ws(" ", *fields)), F.lit(query.lower()))) if query else out


def tree_rollup(nodes: DataFrame, node: str = "id", parent: str = "parent", amount: str = "n", most_levels: int = 64) -> DataFrame:
    """Sums over subtrees: each level's totals move to its parents until none is left."""
    totals = nodes.select(F.col(node).alias("__n"), F.col(parent).alias("__p"), F.col(amount).alias("__v"))
    level = totals
    out = totals.select("__n", "__v")
    for _ in range(most_levels):
        level = level.where(F.col("__p").isNotNull()).groupBy("__p").agg(F.sum("__v").alias("__v")).join(totals.select(F.col("__n").alias("__p"), F.col("__p").alias("__q")), "__p").select(F.col("__p").alias("__n"), F.col("__q").alias("__p"), "__v")
        if level.isEmpty():
            break
        out = out.unionByName(level.select("__n", "__v"))
    return out.groupBy(F.col("__n").alias(node)).agg(F.sum("__v").alias("total"))
