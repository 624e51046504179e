"""Label checks, catalogues, samples and the searches of review pages, all over whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sessiongrain.operators import rollups


def semantic_issues(checks: dict[str, Column]) -> Column:
    """Names of the checks that do not hold, in the order given; an undecided check is an issue."""
    return F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in checks.items()]))


def one_of(value: Column, allowed: tuple[str, ...]) -> Column:
    return value.isin(*allowed)


def readable_names(rows: DataFrame, names: DataFrame, code: str, name: str, into: str, unknown: str = "unknown") -> DataFrame:
    """rows with the display name of a code: "code name", or "unknown (code)" for one that the table of names lacks; null stays null."""
    known = names.select(F.col(code).alias("__c"), F.col(name).alias("__n"))
    both = rows.join(known, rows[code] == known["__c"], "left")
    text = F.col(code).cast("string")
    return both.withColumn(into, F.when(F.col("__n").isNotNull(), F.concat_ws(" ", text, "__n")).when(F.col(code).isNotNull(), F.concat(F.lit(f"{unknown} ("), text, F.lit(")")))).drop("__c", "__n")


def reference_catalog(claims: DataFrame, evidence: DataFrame, claim: str, in_scope: Column, support: str, event: str) -> DataFrame:
    """Claims in scope with their support (the latest review's, else the label's own) and their evidence: (claim, support, n_evidence, events sorted)."""
    own = evidence.groupBy(claim).agg(F.array_sort(F.collect_set(event)).alias("events"))  # a claim's own citations
    kept = claims.where(in_scope).join(own, claim, "left").withColumn("events", F.coalesce("events", F.array().cast(own.schema["events"].dataType)))
    return kept.select(claim, F.coalesce(support, F.lit("unreviewed")).alias("support"), F.size("events").alias("n_evidence"), "events")


def groups_within(rows: DataFrame, group: str, label: str, allowed: DataFrame) -> DataFrame:
    """Each group with within: whether all its labels are in `allowed`. Null labels are not."""
    marked = rows.join(allowed.select(label).distinct().withColumn("__in", F.lit(True)), label, "left")
    return marked.groupBy(group).agg(F.every(F.coalesce("__in", F.lit(False))).alias("within"))


def duplicate_bounds(rows: DataFrame, group: str, case: str, hit: Column) -> DataFrame:
    """Per group the cases of which all versions hit (n_least) and of which any does (n_most)."""
    by_case = rows.groupBy(group, case).agg(F.every(hit).alias("all"), F.some(hit).alias("any"))
    return by_case.groupBy(group).agg(F.count_if("all").alias("n_least"), F.count_if("any").alias("n_most"))


def missing_published(cases: DataFrame, published: DataFrame, case: str, evidence: str) -> DataFrame:
    """(case, n_missing) of cases that cite evidence which is not published."""
    gone = cases.select(case, evidence).distinct().join(published.select(evidence).distinct(), evidence, "left_anti")
    return gone.groupBy(case).agg(F.count("*").alias("n_missing"))


def negative_feedback(rows: DataFrame, explicit: Column, sentiment: Column) -> DataFrame:
    return rows.where(explicit & sentiment.isin("negative", "mixed"))


def matching(rows: DataFrame, audits: DataFrame, keys: list[str]) -> DataFrame:
    """rows that an audit names by all of the keys."""
    return rows.join(audits.select(*keys).distinct(), keys, "left_semi")


def balanced_sample(rows: DataFrame, positive: Column, id_col: str, size_col: str, size: int) -> DataFrame:
    """`size` rows, smallest first: half from either side, each spread evenly over its order of (size_col, id_col); an odd one is
    positive, and what one side lacks is spread over the rest. Null sides count as negative. A sampling operator.
    """
    side = rows.withColumn("__p", F.coalesce(positive, F.lit(False)))
    n = {r["__p"]: r["n"] for r in side.groupBy("__p").agg(F.count("*").alias("n")).collect()}  # two rows
    k = min(n.get(True, 0), (size + 1) // 2)
    quota = {True: k, False: min(n.get(False, 0), size - k)}
    order = [size_col, id_col]
    chosen = rollups.spread_by(side.where("__p"), order, quota[True]).unionByName(rollups.spread_by(side.where("NOT __p"), order, quota[False]))
    short = size - sum(quota.values())
    if short > 0:
        chosen = chosen.unionByName(rollups.spread_by(side.join(chosen.select(id_col), id_col, "left_anti"), order, short).select(chosen.columns))
    return chosen.drop("__p").orderBy(*order)


def fixed_examples(rows: DataFrame, kind: Column, order: str, n: int = 3) -> DataFrame:
    """The first n rows of each kind, in order; rows without a kind give none."""
    return rollups.top_per_group(rows.withColumn("kind", kind).where("kind IS NOT NULL"), ["kind"], [F.asc(order)], n)


def facet_options(rows: DataFrame, fields: list[str]) -> DataFrame:
    """(field, value, n): the distinct non-empty values of each field."""
    long = rows.select(F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields])).alias("o")).select("o.*")
    return long.where("value <> ''").groupBy("field", "value").agg(F.count("*").alias("n"))


def tree_search(nodes: DataFrame, text: str, query: str, node: str = "id", parent: str = "parent", most_levels: int = 64) -> DataFrame:
    """The leaves whose text holds the query, case aside, and all their ancestors: what stays visible."""
    inner = nodes.select(F.col(parent).alias(node)).where(F.col(node).isNotNull()).distinct()
    level = nodes.join(inner, node, "left_anti").where(F.contains(F.lower(text), F.lit(query.lower()))).select(node, parent)
    out = level.select(node)
    for _ in range(most_levels):
        level = level.select(F.col(parent).alias(node)).where(F.col(node).isNotNull()).distinct().join(nodes.select(node, parent), node)
        if level.isEmpty():
            break
        out = out.unionByName(level.select(node))
    return out.distinct()


def same_queries(rows: DataFrame, group: str, order: str, text: str) -> DataFrame:
    """Groups with the same texts in the same order: (digest, n, first) by the digest of the joined text."""
    joined = rows.groupBy(group).agg(F.array_sort(F.collect_list(F.struct(order, text))).alias("parts"))  # a group's own texts
    digest = F.sha2(F.array_join(F.transform("parts", lambda p: p[text]), "\n"), 256)
    return joined.select(group, digest.alias("digest")).groupBy("digest").agg(F.count("*").alias("n"), F.min(group).alias("first"))


def status_by_trace(rows: DataFrame, model: str, trace: str, status: str, precedence: tuple[str, ...]) -> DataFrame:
    """Per model the traces by their gravest status: (model, n_traces, one count a status). Statuses not named are left out."""
    rank = F.array_position(F.array(*map(F.lit, precedence)), F.col(status))
    worst = rows.where(rank > 0).groupBy(model, trace).agg(F.min(rank).alias("r"))
    return worst.groupBy(model).agg(F.count("*").alias("n_traces"), *[F.count_if(F.col("r") == i + 1).alias(f"n_{s}") for i, s in enumerate(precedence)])


def compression_draft(rows: DataFrame, parent: str, child: str, case: str, least_share: float) -> DataFrame:
    """Per parent what merging its rare children into one would do: children, rare ones, the net reduction, and the cases that keep a label of their own.

    A child is rare if it holds less than least_share of all cases; fewer than two rare ones are left as they are.
    """
    total = rows.agg(F.count_distinct(case).alias("total"))
    sizes = rows.groupBy(parent, child).agg(F.count_distinct(case).alias("n")).crossJoin(F.broadcast(total)).withColumn("rare", F.col("n") < least_share * F.col("total"))
    drafts = sizes.groupBy(parent).agg(F.count("*").alias("n_children"), F.count_if("rare").alias("n_rare"))
    kept = rows.join(sizes.where("NOT rare").select(parent, child), [parent, child], "left_semi").groupBy(parent).agg(F.count_distinct(case).alias("n_kept_cases"))
    out = drafts.join(kept, parent, "left").withColumn("n_kept_cases", F.coalesce("n_kept_cases", F.lit(0)))
    return out.withColumn("net_reduction", F.greatest(F.col("n_rare") - 1, F.lit(0)))


# A setting in capitals with a number of three digits or more, and such a number in a user's words.
SETTING = r"\b([A-Z][A-Z0-9_]{2,})\s*=\s*[\"']?(\d{3,})(?![A-Za-z0-9_])"
STATED = r"(?<![A-Za-z0-9_])(\d{3,})(?![A-Za-z0-9_])"


def stated_settings(said: DataFrame, done: DataFrame, key: str, text: str) -> DataFrame:
    """(key, name, value): settings NAME=ddd of `done` (tool results) whose number stands in `said` (user messages) of the same key."""
    pairs = lambda i: F.regexp_extract_all(text, F.lit(SETTING), F.lit(i))
    settings = done.select(key, F.explode(F.arrays_zip(pairs(1).alias("name"), pairs(2).alias("value"))).alias("s")).select(key, "s.name", "s.value").distinct()
    stated = said.select(key, F.explode(F.regexp_extract_all(text, F.lit(STATED), F.lit(1))).alias("value")).distinct()
    return settings.join(stated, [key, "value"], "left_semi").select(key, "name", "value")


def watermark(rows: DataFrame, sequence: str) -> DataFrame:
    """(n_events, max_sequence) of an append-only log: 0 and null if it is empty."""
    return rows.agg(F.count("*").alias("n_events"), F.max(sequence).alias("max_sequence"))


def synced(latest: DataFrame, stored: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(key, digest, changed): latest rows to write, changed where the stored digest differs or is missing. A second run changes none."""
    now = latest.select(key, F.sha2(F.concat_ws("|", *[F.coalesce(F.col(f).cast("string"), F.lit("")) for f in fields]), 256).alias("digest"))
    return now.join(stored.select(key, F.col("digest").alias("__d")), key, "left").select(key, "digest", (~F.col("digest").eqNullSafe(F.col("__d"))).alias("changed"))


def migrated_audits(audits: DataFrame, old_rules: DataFrame, new_rules: DataFrame, rule: str, definition: str) -> DataFrame:
    """Audits whose rule means the same in both policies; those of changed or dropped rules must be made anew and are left out."""
    same = old_rules.select(rule, definition).join(new_rules.select(rule, definition), [rule, definition], "left_semi").select(rule).distinct()
    return audits.join(same, rule, "left_semi")


def clean_name(value: Column) -> Column:
    """A name without what follows its last @."""
    return F.trim(F.regexp_replace(value, r"@[^@]*$", ""))


def payload_chars(*columns: Column) -> Column:
    """Characters of the compact JSON of the columns; null fields are left out."""
    return F.length(F.to_json(F.struct(*columns)))
