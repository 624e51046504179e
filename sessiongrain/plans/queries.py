"""The driver-facing queries: each operator applied to the driver's tables, with SQL where SQL can express it.

conversations stand for ordered session events, events for a typed event stream by user (view = user
message, click = tool call, signup = tool result, purchase = reply, error = error), documents for free text,
labels for labelled cases, the star schema for dimensions and conservation checks.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sessiongrain.functions import scalars, statistics
from sessiongrain.operators import evidence, packing, reviews, rollups, rules, sessions
from sessiongrain.plans import judge
from sessiongrain.sources import files

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def keep(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def key_of(events: DataFrame) -> DataFrame:
    """events with k, the number in their JSON properties."""
    return events.withColumn("k", F.try_variant_get(F.try_parse_json("props"), "$.k", "long"))


def opened_turns(events: DataFrame) -> DataFrame:
    return sessions.carry_forward(events, ["user_id"], ["ts", "event_id"], F.when(F.col("event_type") == "signup", F.col("event_id")), F.col("event_type") == "purchase")


TURNS_SQL = """
WITH m AS (
  SELECT *, CASE WHEN event_type = 'signup' THEN event_id END AS opened,
    coalesce(lag(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id), 0) AS closed FROM events
), p AS (
  SELECT *, sum(closed) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS part FROM m
), t AS (
  SELECT *, last_value(opened IGNORE NULLS) OVER (PARTITION BY user_id, part ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS turn_id FROM p
)
"""


@query("""
WITH t AS (SELECT *, sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS turn_no FROM conversations),
s AS (SELECT conv_id, turn_no, count(*) AS n_rows, count(CASE WHEN role = 'assistant' THEN 1 END) AS n_replies, min(turn) AS first_row FROM t WHERE turn_no > 0 GROUP BY ALL)
SELECT conv_id, turn_no::BIGINT AS turn_no, n_rows, n_replies, first_row,
  CASE WHEN n_replies > 0 THEN 'completed' WHEN turn_no < max(turn_no) OVER (PARTITION BY conv_id) THEN 'interrupted' ELSE 'incomplete' END AS status FROM s
""")
def turn_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sessions.carry_forward(table(spark, sf_dir, "conversations"), ["conv_id"], ["turn"], F.when(F.col("role") == "user", F.col("turn")), into="opened")
    numbered = sessions.turn_index(rows, ["conv_id"], "opened", "turn", "turn_no").where("opened is not null")
    turns = numbered.groupBy("conv_id", F.col("turn_no").cast("long").alias("turn_no")).agg(F.count("*").alias("n_rows"), F.count(F.when(F.col("role") == "assistant", 1)).alias("n_replies"), F.min("turn").alias("first_row"))
    last = F.max("turn_no").over(Window.partitionBy("conv_id"))
    return turns.withColumn("status", F.when(F.col("n_replies") > 0, "completed").when(F.col("turn_no") < last, "interrupted").otherwise("incomplete"))


@query(TURNS_SQL + "SELECT event_id, user_id, coalesce(turn_id, -1) AS turn_id FROM t")
def turn_carry_reset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return opened_turns(table(spark, sf_dir, "events")).select("event_id", "user_id", F.coalesce("turn_id", F.lit(-1)).alias("turn_id"))


def typed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = {"view": "user_message", "click": "tool_call", "signup": "tool_result", "purchase": "assistant_message", "error": "error"}
    e = key_of(table(spark, sf_dir, "events"))
    e = e.select("event_id", "ts", "user_id", "value", scalars.lookup(F.col("event_type"), kinds).alias("type"), "event_type", (F.col("k") % 5).alias("call_id"), F.when((F.col("event_type") == "purchase") & (F.col("value") > 100), "task_complete").alias("native_type"))
    place = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    return sessions.carry_forward(e.withColumn("sequence", place), ["user_id"], ["sequence"], F.when(F.col("type") == "user_message", F.col("event_id")))


TYPED_SQL = """
WITH e AS (
  SELECT event_id, ts, user_id, value, event_type, CAST(json_extract(props, '$.k') AS BIGINT) % 5 AS call_id,
    CASE event_type WHEN 'view' THEN 'user_message' WHEN 'click' THEN 'tool_call' WHEN 'signup' THEN 'tool_result' WHEN 'purchase' THEN 'assistant_message' WHEN 'error' THEN 'error' END AS type,
    CASE WHEN event_type = 'purchase' AND value > 100 THEN 'task_complete' END AS native_type,
    row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS sequence FROM events
), t AS (
  SELECT *, last_value(CASE WHEN type = 'user_message' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY sequence ROWS UNBOUNDED PRECEDING) AS turn_id FROM e
)
"""


@query(TYPED_SQL + """, f AS (
  SELECT user_id, turn_id, bool_or(type = 'error') AS failed, coalesce(bool_or(native_type = 'task_complete'), false) AS done, arg_max(type, sequence) AS last_type,
    len(list_filter(list_distinct(list(call_id) FILTER (WHERE type = 'tool_call')), lambda c: NOT list_contains(coalesce(list(call_id) FILTER (WHERE type = 'tool_result'), []), c))) AS open_calls,
    min(sequence) AS first_seen, count(*) AS n_events FROM t WHERE turn_id IS NOT NULL GROUP BY ALL
), s AS (
  SELECT *, coalesce(open_calls, 0) AS n_open, row_number() OVER (PARTITION BY user_id ORDER BY first_seen) AS turn_index, max(first_seen) OVER (PARTITION BY user_id) AS last_seen FROM f
)
SELECT user_id, turn_id, turn_index::INTEGER AS turn_index, n_events, n_open::INTEGER AS open_calls,
  CASE WHEN failed THEN 'aborted' WHEN done THEN 'completed' WHEN last_type = 'assistant_message' AND n_open = 0 THEN 'completed' WHEN first_seen < last_seen THEN 'interrupted' ELSE 'incomplete' END AS status FROM s
""")
def turn_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sessions.turn_status(typed_events(spark, sf_dir), ["user_id"])
    return found.select("user_id", "turn_id", "turn_index", "n_events", "open_calls", "status")


@query("SELECT conv_id, arg_min(turn, turn) AS turn, arg_min(trim(text, ' '), turn) AS content FROM conversations WHERE role = 'user' AND trim(text, ' ') <> '' GROUP BY conv_id")
def first_user_message(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").alias("event_id"), F.when(F.col("role") == "user", "user_message").alias("type"), "text")
    return sessions.first_user_events(c, ["conv_id"], "event_id", "text").select("conv_id", F.col("event_id").alias("turn"), "content")


@query("""
SELECT user_id, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS types, count(DISTINCT CAST(ts AS DATE)) AS n_days, count(*) AS n_events,
  CASE WHEN count(DISTINCT event_type) = 1 THEN min(event_type) ELSE 'mixed' END AS harness FROM events GROUP BY user_id
""")
def trace_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("user_id", F.to_date("ts").cast("string").alias("day"), "event_type", F.col("event_type").alias("harness"))
    found = sessions.trace_rollup(e, "user_id", "day", "event_type", "harness")
    return found.select("user_id", F.array_join("models", ",").alias("types"), F.size("sessions").cast("long").alias("n_days"), "n_events", "harness")


@query("""
SELECT conv_id, turn, role, coalesce(min(CASE WHEN role = 'user' THEN turn END) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), -1) AS next_user FROM conversations
""")
def next_user_lookahead(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    return sessions.next_where(c, ["conv_id"], ["turn"], F.when(F.col("role") == "user", F.col("turn")), "next_user").select("conv_id", "turn", "role", F.coalesce("next_user", F.lit(-1)).alias("next_user"))


def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.withColumn("pos", F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")) - 1)


def episodes(pos: DataFrame) -> DataFrame:
    """Spans that start at signups and end before the next one, or at the user's last event."""
    last = F.max("pos").over(Window.partitionBy("user_id"))
    starts = pos.withColumn("last_pos", last).where(F.col("event_type") == "signup").select("user_id", F.col("event_id").alias("episode_id"), F.col("pos").alias("start"), "last_pos")
    return sessions.boundaries(starts, ["user_id"], "start", F.col("last_pos"))


EPISODES_SQL = """
WITH pos AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS pos FROM events),
last AS (SELECT user_id, max(pos) AS last_pos FROM pos GROUP BY user_id),
ep AS (SELECT p.user_id, p.event_id AS episode_id, p.pos AS start, coalesce(lead(p.pos) OVER (PARTITION BY p.user_id ORDER BY p.pos) - 1, l.last_pos) AS "end"
  FROM pos AS p JOIN last AS l ON l.user_id = p.user_id WHERE p.event_type = 'signup')
"""


@query(EPISODES_SQL + """SELECT ep.episode_id, count(*) AS n_events, round(sum(pos.value), 2) AS total FROM pos JOIN ep ON ep.user_id = pos.user_id AND pos.pos BETWEEN ep.start AND ep."end" GROUP BY ep.episode_id""")
def episode_span_range_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    pos = positions(spark, sf_dir)
    inside = sessions.spans(pos, episodes(pos), ["user_id"], "pos", ["episode_id"])
    return inside.groupBy("episode_id").agg(F.count("*").alias("n_events"), F.round(F.sum("value"), 2).alias("total"))


@query(EPISODES_SQL + """, r AS (SELECT user_id, start, "end" + 1 AS stop FROM ep)
SELECT pos.event_id, count(r.start) AS times FROM pos LEFT JOIN r ON r.user_id = pos.user_id AND pos.pos BETWEEN r.start AND r.stop GROUP BY pos.event_id""")
def partition_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    pos = positions(spark, sf_dir)
    wider = episodes(pos).select("user_id", "start", (F.col("end") + 1).alias("end"))
    found = sessions.coverage(pos.select("user_id", "pos"), wider, ["user_id"])
    return pos.join(found, ["user_id", "pos"]).select("event_id", F.col("times").cast("long").alias("times"))


@query(EPISODES_SQL + """SELECT episode_id, user_id, start, "end" AS stop FROM ep""")
def lead_boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = episodes(positions(spark, sf_dir))
    return e.select("episode_id", "user_id", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("stop"))


@query("""
WITH n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events)
SELECT a.event_id, a.user_id FROM n AS a LEFT JOIN n AS b ON b.user_id = a.user_id AND b.rn = a.rn + 1 AND b.event_type = 'view' WHERE a.event_type = 'error' AND b.event_id IS NULL
""")
def unmatched_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pos = positions(spark, sf_dir)
    calls = pos.where("event_type = 'error'").select("user_id", (F.col("pos") + 1).alias("pos"), "event_id")
    return calls.join(pos.where("event_type = 'view'"), ["user_id", "pos"], "left_anti").select("event_id", "user_id")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def orders_without_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, li = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    return o.join(li, o["o_orderkey"] == li["l_orderkey"], "left_anti").select("o_orderkey", "o_custkey")


@query("SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 400000)")
def semi_routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, o = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT' AND o_totalprice > 400000")
    return c.join(o, c["c_custkey"] == o["o_custkey"], "left_semi").select("c_custkey", "c_mktsegment")


FEATURES_SQL = """
WITH f AS (
  SELECT d.doc_id, d.lang, d.source, CASE WHEN lang = 'en' THEN 'in_scope' WHEN lang = 'de' THEN 'adjacent' WHEN lang = 'fr' THEN 'out_of_scope' ELSE 'uncertain' END AS domain,
    CASE WHEN n_chars > 4000 THEN 'high' WHEN n_chars > 1000 THEN 'medium' WHEN n_chars > 100 THEN 'uncertain' ELSE 'low' END AS value,
    CASE WHEN d.doc_id % 7 = 0 THEN 'uncertain' ELSE 'reliable' END AS boundary,
    CASE WHEN d.doc_id % 11 = 0 THEN 'not_identifiable' ELSE 'identified' END AS query,
    CASE WHEN l.quality = 1 THEN 'clear' WHEN l.quality = 0 THEN 'unclear' ELSE 'partly_clear' END AS clarity,
    CASE WHEN d.doc_id % 3 = 0 THEN 'insufficient' WHEN d.doc_id % 3 = 1 THEN 'partial' ELSE 'complete' END AS goal,
    CASE WHEN l.toxic = 1 THEN 'present' WHEN l.toxic = 0 THEN 'absent' ELSE 'present' END AS signals, l.quality, l.toxic, d.n_chars
  FROM documents AS d LEFT JOIN labels AS l ON l.doc_id = d.doc_id
)
"""
ROUTE_SQL = """CASE WHEN domain = 'out_of_scope' OR value = 'low' OR (query = 'not_identifiable' AND goal = 'insufficient') THEN 'skip'
 WHEN domain IN ('in_scope', 'adjacent') AND value IN ('high', 'medium') AND boundary = 'reliable' AND query = 'identified' AND clarity = 'clear' AND goal IN ('complete', 'partial') AND signals = 'present' THEN 'analyze' ELSE 'review' END"""


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, lab = table(spark, sf_dir, "documents").drop("text"), table(spark, sf_dir, "labels")
    f = d.join(lab, "doc_id", "left")
    i = F.col("doc_id")
    return f.select(
        "doc_id", "lang", "source", "n_chars", "quality", "toxic",
        scalars.lookup(F.col("lang"), {"en": "in_scope", "de": "adjacent", "fr": "out_of_scope"}, F.lit("uncertain")).alias("domain"),
        F.when(F.col("n_chars") > 4000, "high").when(F.col("n_chars") > 1000, "medium").when(F.col("n_chars") > 100, "uncertain").otherwise("low").alias("value"),
        F.when(i % 7 == 0, "uncertain").otherwise("reliable").alias("boundary"), F.when(i % 11 == 0, "not_identifiable").otherwise("identified").alias("query"),
        F.when(F.col("quality") == 1, "clear").when(F.col("quality") == 0, "unclear").otherwise("partly_clear").alias("clarity"),
        F.when(i % 3 == 0, "insufficient").when(i % 3 == 1, "partial").otherwise("complete").alias("goal"),
        F.when(F.col("toxic") == 0, "absent").otherwise("present").alias("signals"),
    )


def routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = features(spark, sf_dir)
    return f.withColumn("route", rules.episode_route(*[F.col(c) for c in ("domain", "value", "boundary", "query", "clarity", "goal", "signals")]))


@query(FEATURES_SQL + f"SELECT doc_id, {ROUTE_SQL} AS route FROM f")
def episode_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routed(spark, sf_dir).select("doc_id", "route")


@query(FEATURES_SQL + f""", r AS (SELECT source, {ROUTE_SQL} AS route FROM f)
SELECT source, CASE WHEN bool_or(route = 'analyze') THEN 'analyze' WHEN bool_or(route = 'review') THEN 'review' ELSE 'skip' END AS route FROM r GROUP BY source""")
def trace_priority_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.status_rollup(routed(spark, sf_dir), ["source"], "route", ("analyze", "review", "skip"))


@query(FEATURES_SQL + """, g AS (SELECT doc_id, quality = 1 AS g1, toxic = 0 AS g2, doc_id % 5 <> 0 AS g3, CASE WHEN doc_id % 13 = 0 THEN NULL ELSE doc_id % 2 = 0 END AS g4,
 CASE doc_id % 4 WHEN 0 THEN 'complete' WHEN 1 THEN 'partial' WHEN 2 THEN 'broken' END AS integrity FROM f)
SELECT doc_id, CASE WHEN g1 AND g2 AND g3 AND g4 AND integrity = 'complete' THEN 'high' WHEN NOT g1 OR NOT g2 OR NOT g3 OR NOT g4 OR integrity = 'broken' THEN 'low'
 WHEN g1 IS NULL OR g2 IS NULL OR g3 IS NULL OR g4 IS NULL OR coalesce(integrity, 'unknown') = 'unknown' THEN 'unknown' ELSE 'medium' END AS gate FROM g""")
def quality_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("doc_id")
    gates = [F.col("quality") == 1, F.col("toxic") == 0, i % 5 != 0, F.when(i % 13 != 0, i % 2 == 0)]
    integrity = F.when(i % 4 == 0, "complete").when(i % 4 == 1, "partial").when(i % 4 == 2, "broken")
    return features(spark, sf_dir).select("doc_id", rules.quality_gates(gates, integrity).alias("gate"))


@query("""
WITH d AS (SELECT doc_id, source, CASE WHEN doc_id % 2 = 0 THEN ' ' || upper(lang) || ' ' ELSE lang END AS label FROM documents)
SELECT lower(trim(label, ' ')) AS label_key, arg_min(trim(label, ' '), doc_id) AS label, count(*) AS n, count(DISTINCT source) AS n_traces, round_even(count(*) / sum(count(*)) OVER (), 4) AS share FROM d GROUP BY 1
""")
def label_distribution_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "source", F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit(" "), F.upper("lang"), F.lit(" "))).otherwise(F.col("lang")).alias("label"))
    return rollups.distribution(d, "label", "doc_id", "doc_id", "source")


@query("""
SELECT event_type, count(DISTINCT CASE WHEN value < 20 THEN user_id END) AS low, count(DISTINCT CASE WHEN value >= 20 AND value < 80 THEN user_id END) AS mid, count(DISTINCT CASE WHEN value >= 80 THEN user_id END) AS high FROM events GROUP BY event_type
""")
def model_status_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    band = F.when(F.col("value") < 20, "low").when(F.col("value") < 80, "mid").otherwise("high")
    return rollups.pivot_counts(table(spark, sf_dir, "events").withColumn("band", band), "event_type", "band", ["low", "mid", "high"], "user_id")


@query("""
WITH s AS (SELECT user_id, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS event_type, string_agg(DISTINCT band, ',' ORDER BY band) AS band, count(*) AS n, bool_or(value > 300) AS flagged
  FROM (SELECT *, CASE WHEN value < 20 THEN 'low' WHEN value < 80 THEN 'mid' ELSE 'high' END AS band FROM events) GROUP BY user_id)
SELECT event_type, band, count(*) AS n_keys, sum(n)::BIGINT AS n_rows, count(CASE WHEN flagged THEN 1 END) AS n_flagged FROM s GROUP BY ALL
""")
def configuration_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    band = F.when(F.col("value") < 20, "low").when(F.col("value") < 80, "mid").otherwise("high")
    e = table(spark, sf_dir, "events").withColumn("band", band).withColumn("flag", F.col("value") > 300)
    return rollups.configurations(e, "user_id", ["event_type", "band"], "flag")


@query("""
SELECT n_nationkey, n_name, count(DISTINCT c_custkey) AS n_cases, count(DISTINCT CASE WHEN c_acctbal > 9500 THEN c_custkey END) AS n_flagged
FROM nation LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment = 'MACHINERY' AND c_acctbal > 9000) ON c_nationkey = n_nationkey GROUP BY ALL
""")
def incidence_with_zero_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").where("c_mktsegment = 'MACHINERY' AND c_acctbal > 9000").withColumnRenamed("c_nationkey", "n_nationkey")
    return rollups.incidence(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"), c, "n_nationkey", "c_custkey", F.col("c_acctbal") > 9500)


@query("SELECT p_brand, p_partkey, p_retailprice, rank FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey)::INTEGER AS rank FROM part) WHERE rank <= 3")
def top3_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.top_per_group(table(spark, sf_dir, "part"), ["p_brand"], [F.desc("p_retailprice"), F.asc("p_partkey")], 3).select("p_brand", "p_partkey", "p_retailprice", "rank")


@query("""
WITH r AS (SELECT doc_id, lang, n_chars > 2000 AS long, sha256('pilot|' || doc_id) AS h FROM documents), n AS (SELECT count(*) AS strata FROM (SELECT DISTINCT lang, long FROM r)),
o AS (SELECT *, row_number() OVER (PARTITION BY lang, long ORDER BY h, doc_id) AS k FROM r)
SELECT doc_id, lang, long FROM o, n ORDER BY CASE WHEN k > 40 // strata THEN 1 ELSE 0 END, h, doc_id LIMIT 40
""")
def stratified_sample_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", (F.col("n_chars") > 2000).alias("long"))
    return rollups.stratified_sample(d, ["lang", "long"], "doc_id", 40)


@query("""
WITH p AS (SELECT doc_id, n_chars, row_number() OVER (ORDER BY n_chars, doc_id) - 1 AS pos, count(*) OVER () AS n FROM documents)
SELECT doc_id, n_chars FROM p WHERE pos IN (SELECT CAST(round_even(i * (n - 1) / 24.0, 0) AS BIGINT) FROM (SELECT DISTINCT n FROM p), range(25) AS t(i))
""")
def spread_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("n_chars", "doc_id")
    n = d.count()
    wanted = sorted({round(i * (n - 1) / 24) for i in range(25)})
    return rollups.global_position(d, ["n_chars", "doc_id"]).where(F.col("position").isin(wanted)).select("doc_id", "n_chars")


@query("SELECT user_id, event_id AS revision, event_type AS decision, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS r FROM events) WHERE r = 1")
def latest_revision(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("user_id", F.col("event_id").alias("revision"), F.col("event_id").alias("event_sequence"), F.col("event_type").alias("decision"), "value")
    return reviews.latest_reviews(e, "user_id").select("user_id", "revision", "decision", "value")


@query("""
SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE NOT (o_orderkey % 10 = 0 AND o_orderstatus = 'O')
UNION ALL SELECT o_orderkey, 'X', o_totalprice FROM orders WHERE o_orderkey % 10 = 0 AND o_orderstatus = 'O'
""")
def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    delta = o.where("o_orderkey % 10 = 0 AND o_orderstatus = 'O'").withColumn("o_orderstatus", F.lit("X"))
    return files.upsert(o, delta, ["o_orderkey"])


@query("SELECT source, lang, count(DISTINCT sha256(text)) AS n_versions, count(*) AS n_copies FROM documents GROUP BY ALL HAVING count(DISTINCT sha256(text)) > 1")
def conflict_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.version_conflicts(table(spark, sf_dir, "documents"), ["source", "lang"], ["text"])


@query("SELECT sha256(text) AS same, count(*) AS n, arg_max(doc_id, (n_chars, doc_id)) AS winner FROM documents GROUP BY 1 HAVING count(*) > 1")
def boundary_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "n_chars", F.sha2("text", 256).alias("same"))
    return rollups.duplicate_groups(d, ["same"], [F.desc("n_chars"), F.desc("doc_id")], "doc_id").select("same", "n", "winner")


@query("SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels")
def set_difference_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id").subtract(table(spark, sf_dir, "labels").select("doc_id"))


@query("""
WITH b AS (SELECT l_orderkey, l_linenumber, max(l_returnflag) AS flag, max(l_quantity) AS quantity FROM lineitem WHERE l_linestatus = 'F' OR l_discount > 0.02 GROUP BY ALL),
a AS (SELECT l_orderkey, l_linenumber, max(CASE WHEN l_tax > 0.05 THEN 'N' ELSE l_returnflag END) AS flag, max(l_quantity) AS quantity FROM lineitem WHERE l_linestatus = 'O' OR l_quantity > 5 GROUP BY ALL)
SELECT coalesce(a.l_orderkey, b.l_orderkey) AS l_orderkey, coalesce(a.l_linenumber, b.l_linenumber) AS l_linenumber,
  CASE WHEN a.l_orderkey IS NULL THEN 'added' WHEN b.l_orderkey IS NULL THEN 'removed' WHEN a.flag = b.flag AND a.quantity = b.quantity THEN 'same' ELSE 'changed' END AS change
FROM a FULL OUTER JOIN b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber = b.l_linenumber
""")
def case_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two versions of the order lines, by what they say of themselves."""
    rows = table(spark, sf_dir, "lineitem")
    version = lambda df, flag: df.groupBy("l_orderkey", "l_linenumber").agg(F.max(flag).alias("flag"), F.max("l_quantity").alias("quantity"))
    old = version(rows.where("l_linestatus = 'O' OR l_quantity > 5"), F.when(F.col("l_tax") > 0.05, "N").otherwise(F.col("l_returnflag")))
    new = version(rows.where("l_linestatus = 'F' OR l_discount > 0.02"), F.col("l_returnflag"))
    return rollups.compare(old, new, ["l_orderkey", "l_linenumber"], ["flag", "quantity"])


@query("SELECT doc_id, lang, source FROM documents WHERE lang = 'en' AND contains(lower(source || ' ' || text), 'license')")
def faceted_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.facets(table(spark, sf_dir, "documents"), {"lang": "en", "source": ""}, {}, "License", ["source", "text"]).select("doc_id", "lang", "source")


SIMPLE = ((r"[A-Za-z0-9._+-]{1,64}@[A-Za-z0-9.-]{1,253}\.[A-Za-z]{2,63}", "<EMAIL>"), (r"\b[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\b", "<IP_ADDRESS>"), (r"sk-[A-Za-z0-9_-]{12,}", "<API_KEY>"))


def _simple_sql(column: str) -> str:
    for pattern, put in SIMPLE:
        column = f"regexp_replace({column}, '{pattern}', '{put}', 'g')"
    return column


@query(f"SELECT doc_id, sha256({_simple_sql('text')}) AS redacted_sha256, length({_simple_sql('text')}) AS n FROM documents")
def redact_simple(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", scalars.replace_all(F.col("text"), SIMPLE).alias("t"))
    return d.select("doc_id", F.sha2("t", 256).alias("redacted_sha256"), F.length("t").cast("long").alias("n"))


@query()
def redact_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "text", scalars.redact(F.col("text")).alias("t"))
    return d.select("doc_id", (F.col("text") != F.col("t")).alias("changed"), F.sha2("t", 256).alias("redacted_sha256"))


MASK_SQL = "t"
for _pattern, _mask in (*scalars.PUBLIC_MASKS[:3], (r"(^|[^\p{L}\p{M}\p{N}_.])/(?:[^\s/]+/)+[^\s,;，。；：:]+", r"\1" + scalars.PUBLIC_MASKS[3][1])):  # no look-behind in RE2
    MASK_SQL = f"regexp_replace({MASK_SQL}, '{_pattern}', '{_mask}', 'g')"


@query(f"SELECT page_id, length({MASK_SQL}) AS n_chars, sha256({MASK_SQL}) AS masked_sha256 FROM (SELECT page_id, url || ' ' || html AS t FROM pages)")
def public_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All masks over whole addresses and pages."""
    masked = scalars.replace_all(F.concat_ws(" ", "url", "html"), scalars.PUBLIC_MASKS)
    return table(spark, sf_dir, "pages").select("page_id", masked.alias("m")).select("page_id", F.length("m").cast("long").alias("n_chars"), F.sha2("m", 256).alias("masked_sha256"))


@query("SELECT doc_id, 'case_' || left(sha256(lang || '|' || source || '|' || doc_id), 24) AS case_id FROM documents")
def stable_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", scalars.case_id(F.col("lang"), F.col("source"), F.col("doc_id")).alias("case_id"))


PATTERNS = [("license", "(?i)licen[cs]e"), ("secret", "(?i)token|password|api_?key"), ("mail", "[A-Za-z0-9.]+@[A-Za-z0-9.]+"), ("junk", "[%&$#*]{3}")]
_HITS_SQL = " UNION ALL ".join(
    f"""SELECT '{n}' AS label, doc_id, text, strpos(text, regexp_extract(text, '{p}'))::INTEGER AS start, regexp_extract(text, '{p}') AS m FROM documents WHERE regexp_matches(text, '{p}')""" for n, p in PATTERNS
)


@query(f"SELECT label, count(*) AS n_cases, count(DISTINCT doc_id) AS n_docs, min(doc_id) AS first_doc FROM ({_HITS_SQL}) GROUP BY label")
def keyword_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = evidence.keyword_hits(table(spark, sf_dir, "documents"), PATTERNS, "doc_id", "text")
    return hits.groupBy("label").agg(F.count("*").alias("n_cases"), F.count_distinct("doc_id").alias("n_docs"), F.min("doc_id").alias("first_doc"))


@query(f"SELECT label, doc_id, start, substr(text, greatest(1, start - 40), start - greatest(1, start - 40) + length(m) + 40) AS snippet FROM ({_HITS_SQL})")
def snippets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evidence.keyword_hits(table(spark, sf_dir, "documents"), PATTERNS, "doc_id", "text")


@query("""
SELECT doc_id, c::INTEGER AS chunk, doc_id || '#chunk_' || lpad(c::VARCHAR, 4, '0') AS chunk_id, sha256(substr(text, c * 1000 + 1, 1000)) AS body_hash
FROM (SELECT doc_id, text, unnest(range((length(text) + 999) // 1000)) AS c FROM documents WHERE length(text) > 0)
""")
def chunk_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evidence.chunks(table(spark, sf_dir, "documents"), "doc_id", "text", 1000).select("doc_id", "chunk", "chunk_id", F.sha2("text", 256).alias("body_hash"))


@query("""
WITH RECURSIVE d AS (SELECT source, doc_id, n_chars AS n, row_number() OVER w AS r, sum(n_chars) OVER w AS upto FROM documents WINDOW w AS (PARTITION BY source ORDER BY doc_id ROWS UNBOUNDED PRECEDING)),
b AS (SELECT source, 0 AS bin, r, upto - n AS before FROM d WHERE r = 1
  UNION ALL SELECT d.source, bin + 1, d.r, d.upto - d.n FROM b JOIN d ON d.source = b.source AND d.r > b.r AND d.upto > before + 50000 AND (d.upto - d.n <= before + 50000 OR d.r = b.r + 1))
SELECT d.source, bin::INTEGER AS bin, count(*) AS n, sum(n)::BIGINT AS chars FROM d ASOF JOIN b ON d.source = b.source AND d.r >= b.r GROUP BY d.source, bin
""")
def prompt_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("source", "doc_id", F.col("n_chars").alias("size"))
    return packing.pack(d, "source", "doc_id", "size", 50_000).groupBy("source", "bin").agg(F.count("*").alias("n"), F.sum("size").alias("chars"))


@query("""
WITH q AS (SELECT doc_id, substr(text, 5, 30) AS quote FROM documents WHERE length(text) > 40), t AS (SELECT doc_id, max(doc_id) OVER (PARTITION BY lang, source ORDER BY doc_id ROWS BETWEEN 1 PRECEDING AND 1 PRECEDING) AS before FROM documents),
a AS (SELECT q.doc_id, quote, q.doc_id AS event_id, 'own' AS kind FROM q UNION ALL SELECT q.doc_id, quote, coalesce(before, -1), 'other' FROM q JOIN t USING (doc_id))
SELECT a.doc_id, a.kind, CASE WHEN e.text IS NULL THEN 'unknown_event' WHEN contains(e.text, a.quote) THEN 'valid' ELSE 'quote_not_exact' END AS outcome FROM a LEFT JOIN documents AS e ON e.doc_id = a.event_id
""")
def citation_contained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's quote against its own text and that of the document before it in its language and source; the first ones have none."""
    d = table(spark, sf_dir, "documents")
    before = F.lag("doc_id").over(Window.partitionBy("lang", "source").orderBy("doc_id"))
    quotes = d.select("doc_id", F.substring("text", 5, 30).alias("quote"), F.length("text").alias("n"), F.coalesce(before, F.lit(-1)).alias("before")).where("n > 40")
    cited = quotes.select("doc_id", "quote", F.explode(F.array(F.struct(F.col("doc_id").alias("event_id"), F.lit("own").alias("kind")), F.struct(F.col("before").alias("event_id"), F.lit("other").alias("kind")))).alias("c")).select("doc_id", "quote", "c.*")
    return evidence.quote_checks(cited, d.select(F.col("doc_id").alias("event_id"), F.col("text").alias("body"))).select("doc_id", "kind", "outcome")


def value_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id, label): event type and hundreds of the value, as labels of users."""
    return table(spark, sf_dir, "events").select("user_id", F.concat_ws(":", "event_type", F.floor(F.col("value") / 25).cast("string")).alias("label")).distinct()


PAIRS_SQL = """
WITH i AS (SELECT DISTINCT user_id, event_type || ':' || CAST(floor(value / 25) AS BIGINT) AS label FROM events), s AS (SELECT label, count(*) AS n FROM i GROUP BY label),
total AS (SELECT count(DISTINCT user_id) AS n FROM i),
b AS (SELECT x.label AS a, y.label AS b, count(*) AS n_both FROM i AS x JOIN i AS y ON x.user_id = y.user_id AND x.label < y.label GROUP BY ALL),
p AS (SELECT b.a, b.b, b.n_both, l.n AS left_n, r.n AS right_n, total.n AS total FROM b JOIN s AS l ON l.label = b.a JOIN s AS r ON r.label = b.b, total)
"""


def label_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = value_labels(spark, sf_dir)
    return statistics.pair_counts(base, "label", "user_id").crossJoin(F.broadcast(base.agg(F.count_distinct("user_id").alias("total"))))


@query(PAIRS_SQL + "SELECT a, b, n_both, left_n, right_n, round_even(n_both / (left_n + right_n - n_both), 6) AS jaccard, round_even(n_both * total / (left_n * right_n), 6) AS lift FROM p")
def cooccurrence_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = label_pairs(spark, sf_dir)
    n_both, a, b, n = (F.col(c) for c in ("both", "left_n", "right_n", "total"))
    return p.select("a", "b", F.col("both").alias("n_both"), "left_n", "right_n", F.bround(scalars.jaccard(n_both, a, b), 6).alias("jaccard"), F.bround(scalars.lift(n_both, a, b, n), 6).alias("lift"))


@query("""
WITH g AS (SELECT user_id, count(*) AS n, count(CASE WHEN value > 150 THEN 1 END) AS k FROM events GROUP BY user_id)
SELECT user_id, n, k, round(least(1.0, CASE WHEN k >= n THEN 1.0 ELSE (SELECT sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln(0.05) + (n - i) * ln(0.95))) FROM range(k + 1) AS t(i)) END), 9) AS cdf FROM g
""")
def binomial_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = table(spark, sf_dir, "events").groupBy("user_id").agg(F.count("*").alias("n"), F.count(F.when(F.col("value") > 150, 1)).alias("k"))
    return statistics.binomial_cdf(g, "k", "n", 0.05).select("user_id", "n", "k", F.round("cdf", 9).alias("cdf"))


FISHER_SQL = PAIRS_SQL + """, f AS (
  SELECT a, b, least(1.0, (SELECT sum(exp(lgamma(left_n + 1) - lgamma(i + 1) - lgamma(left_n - i + 1) + lgamma(total - left_n + 1) - lgamma(right_n - i + 1) - lgamma(total - left_n - right_n + i + 1)
    - lgamma(total + 1) + lgamma(right_n + 1) + lgamma(total - right_n + 1))) FROM range(greatest(n_both, left_n + right_n - total), least(left_n, right_n) + 1) AS t(i))) AS p FROM p)
"""


@query(FISHER_SQL + "SELECT a, b, round(p, 8) AS p FROM f")
def fisher_greater(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.fisher_greater(label_pairs(spark, sf_dir), "both", "left_n", "right_n", "total").select("a", "b", F.round("p", 8).alias("p"))


@query(FISHER_SQL + """, r AS (SELECT a, b, round(p, 8) AS p FROM f), k AS (SELECT *, row_number() OVER (ORDER BY p, a, b) AS rank, count(*) OVER () AS m FROM r), h AS (SELECT sum(1.0 / i) AS h FROM range(1, (SELECT count(*) + 1 FROM r)) AS t(i))
SELECT a, b, p, round(min(least(1.0, p * m * h / rank)) OVER (ORDER BY rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 7) AS q FROM k, h""")
def by_adjust(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.by_adjust(fisher_greater(spark, sf_dir), "p").select("a", "b", "p", F.round("q", 7).alias("q"))


@query("""
WITH RECURSIVE g AS (
  SELECT event_type, count(DISTINCT CASE WHEN value > 200 THEN user_id END) AS k, count(DISTINCT user_id) AS n FROM events GROUP BY event_type
), b AS (
  SELECT event_type, k, n, 0 AS step, 0.0::DOUBLE AS l0, 1.0::DOUBLE AS l1, 0.0::DOUBLE AS u0, 1.0::DOUBLE AS u1 FROM g
  UNION ALL
  SELECT event_type, k, n, step + 1, CASE WHEN lt < 0.05 THEN (l0 + l1) / 2 ELSE l0 END, CASE WHEN lt < 0.05 THEN l1 ELSE (l0 + l1) / 2 END,
    CASE WHEN ut < 0.95 THEN (u0 + u1) / 2 ELSE u0 END, CASE WHEN ut < 0.95 THEN u1 ELSE (u0 + u1) / 2 END
  FROM (
    SELECT *, coalesce(list_sum(list_transform(range(k, n + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln((l0 + l1) / 2) + (n - i) * ln(1 - (l0 + l1) / 2)))), 0) AS lt,
      coalesce(list_sum(list_transform(range(k + 1, n + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln((u0 + u1) / 2) + (n - i) * ln(1 - (u0 + u1) / 2)))), 0) AS ut
    FROM b WHERE step < 44
  )
)
SELECT event_type, k, n, CASE WHEN k = 0 THEN 0.0 ELSE round((l0 + l1) / 2, 8) END AS lower, CASE WHEN k = n THEN 1.0 ELSE round((u0 + u1) / 2, 8) END AS upper FROM b WHERE step = 44
""")
def clopper_pearson(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = table(spark, sf_dir, "events").groupBy("event_type").agg(F.count_distinct("user_id").alias("n"), F.count_distinct(F.when(F.col("value") > 200, F.col("user_id"))).alias("k"))
    k, n = F.col("k"), F.col("n")
    return g.select("event_type", "k", "n", F.round(statistics.clopper_pearson(k, n, upper=False), 8).alias("lower"), F.round(statistics.clopper_pearson(k, n), 8).alias("upper"))


@query()
def bootstrap_ci(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumn("hit", F.col("value") > 100)
    return statistics.bootstrap_interval(e, "hit", "user_id", "event_type").select("event_type", F.round("low", 6).alias("low"), F.round("high", 6).alias("high"))


@query("SELECT level::DOUBLE AS level, count(CASE WHEN n_chars >= level THEN 1 END) AS n, round_even(count(CASE WHEN n_chars >= level THEN 1 END) / count(*), 4) AS share FROM documents, (VALUES (500), (2000), (8000)) AS t(level) GROUP BY level")
def threshold_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.thresholds(table(spark, sf_dir, "documents"), "n_chars", [500.0, 2000.0, 8000.0])


@query(FEATURES_SQL + """, r AS (
  SELECT doc_id, doc_id % 17 <> 0 AS valid, CASE WHEN lang = 'es' THEN 'fail' WHEN lang = 'de' THEN 'pending' ELSE 'pass' END AS scope, doc_id % 19 = 0 AS conflicts,
    CASE WHEN quality = 1 THEN 'pass' ELSE 'pending' END AS s1, CASE WHEN n_chars > 1000 THEN 'pass' WHEN n_chars < 100 THEN 'fail' ELSE 'pending' END AS s2,
    CASE WHEN toxic = 1 THEN 'fail' WHEN toxic = 0 THEN 'pass' ELSE 'pending' END AS s3, CASE WHEN doc_id % 3 = 0 THEN 'pending' ELSE 'pass' END AS s4 FROM f
), c AS (SELECT doc_id, valid, scope, conflicts, CASE WHEN conflicts AND s1 = 'fail' THEN 'pending' ELSE s1 END AS s1, CASE WHEN conflicts AND s2 = 'fail' THEN 'pending' ELSE s2 END AS s2,
    CASE WHEN conflicts AND s3 = 'fail' THEN 'pending' ELSE s3 END AS s3, s4 FROM r)
SELECT doc_id, CASE WHEN NOT valid THEN 'review' WHEN scope = 'fail' OR s1 = 'fail' OR s2 = 'fail' OR s3 = 'fail' THEN 'not_selected'
  WHEN scope = 'pass' AND s1 = 'pass' AND s2 = 'pass' AND s3 = 'pass' AND s4 = 'pass' AND NOT conflicts THEN 'priority_candidate' ELSE 'review' END AS decision FROM c""")
def selection_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    f, i = features(spark, sf_dir), F.col("doc_id")
    s1 = F.when(F.col("quality") == 1, "pass").otherwise("pending")
    s2 = F.when(F.col("n_chars") > 1000, "pass").when(F.col("n_chars") < 100, "fail").otherwise("pending")
    s3 = F.when(F.col("toxic") == 1, "fail").when(F.col("toxic") == 0, "pass").otherwise("pending")
    s4 = F.when(i % 3 == 0, "pending").otherwise("pass")
    scope = F.when(F.col("lang") == "es", "fail").when(F.col("lang") == "de", "pending").otherwise("pass")
    return f.select("doc_id", rules.selection_decision(i % 17 != 0, scope, i % 19 == 0, [s1, s2, s3, s4]).alias("decision"))


@query("""
WITH g AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM events)
SELECT event_id, user_id, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS session_no FROM g
""")
def sessionized_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.sessionize(table(spark, sf_dir, "events"), "user_id", "ts", 1800).select("event_id", "user_id", F.col("session_no").cast("long").alias("session_no"))


@query("""
WITH c AS (SELECT doc_id % 50 AS batch, doc_id, CASE WHEN contains(text, '%%%') THEN 'a' END AS c1, CASE WHEN contains(lower(text), 'license') THEN 'b' END AS c2 FROM documents)
SELECT batch, CASE WHEN bool_or(c1 IS NOT NULL) THEN 'agent_verify_only' ELSE 'manual_triage' END AS mode, CASE WHEN bool_or(c1 IS NOT NULL) OR bool_or(doc_id % 97 = 0) THEN 'high' ELSE 'medium' END AS priority, count(*) AS n FROM c GROUP BY batch
""")
def remediation_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    codes = rules.issue_codes(F.lit(""), F.contains(F.col("text"), F.lit("%%%")), F.lit(False))
    rows = d.select((F.col("doc_id") % 50).alias("batch_id"), F.lit("r").alias("run_id"), F.lit("t").alias("trace_id"), codes.alias("codes"), (F.col("doc_id") % 97 == 0).alias("seed"))
    n = rows.groupBy("batch_id").agg(F.count("*").alias("n"))
    return reviews.remediation_queue(rows).join(n, "batch_id").select(F.col("batch_id").alias("batch"), "mode", "priority", "n")


@query("SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM lineitem WHERE l_shipdate <= TIMESTAMP '1999-06-01' GROUP BY ALL")
def dimensional_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").where(F.col("l_shipdate") <= F.lit("1999-06-01").cast("timestamp"))
    return li.groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("qty"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"))


@query("SELECT conv_id AS request_id, CAST(sum(length(text)) + count(*) - 1 AS BIGINT) AS chars, false AS cached FROM conversations GROUP BY conv_id")
def judge_boundary(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    prompts = c.groupBy(F.col("conv_id").alias("request_id")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda x: x["text"]), "\n").alias("prompt"))
    out = judge.call_judge(prompts, judge.echo_judge, "count")
    return out.select("request_id", F.get_json_object("answer", "$.chars").cast("long").alias("chars"), "cached")
