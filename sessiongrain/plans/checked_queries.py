"""Queries of schema checks, raw-file reads and products with coverage, with SQL."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sessiongrain.operators import evidence, schemas, workspace
from sessiongrain.plans import boundaries, reanalysis, worklist
from sessiongrain.plans.queries import TURNS_SQL, opened_turns, query, table
from sessiongrain.sources import byte_lines

#: What an event record must look like; `user` stands in a schema of its own.
USER_SCHEMA = {
    "$id": "https://example.org/common.schema.json",
    "$defs": {
        "name": {"type": "string", "minLength": 2, "pattern": "^u[0-9]+$"},
        "user": {
            "type": "object", "required": ["id", "tags"], "additionalProperties": False,
            "properties": {"id": {"$ref": "#/$defs/name"}, "tags": {"type": "array", "minItems": 1, "maxItems": 3, "uniqueItems": True, "items": {"enum": ["click", "view", "signup", "large"]}}},
        },
    },
}
EVENT_SCHEMA = {
    "type": "object",
    "required": ["kind", "value", "user", "at"],
    "properties": {
        "kind": {"enum": ["click", "view", "purchase", "signup"]},
        "value": {"type": "number", "minimum": 2, "exclusiveMaximum": 40},
        "user": {"$ref": "common.schema.json#/$defs/user"},
        "at": {"type": "string", "format": "date-time"},
        "props": {"type": "object", "properties": {"k": {"anyOf": [{"type": "integer", "maximum": 89}, {"const": 95}]}}, "not": {"required": ["secret"]}},
    },
    "allOf": [{"if": {"properties": {"kind": {"const": "click"}}, "required": ["kind"]}, "then": {"properties": {"value": {"maximum": 15}}}, "else": {"properties": {"user": {"properties": {"id": {"maxLength": 3}}}}}}],
}


def event_records(events: DataFrame) -> DataFrame:
    """events with `record`: the event as JSON; small values are left out, some users carry a further field, dates lack their time on the first of a month."""
    big = F.col("value") > 100
    tags = F.array_compact(F.array(F.col("event_type"), F.when(F.col("value") > 30, "large"), F.when(F.col("value") > 60, F.col("event_type"))))
    user = F.struct(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("id"), tags.alias("tags"), F.when(big, "x").alias("extra"))
    at = F.when(F.dayofmonth("ts") == 1, F.date_format("ts", "yyyy-MM-dd")).otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    record = F.struct(F.col("event_type").alias("kind"), F.when(F.col("value") >= 1, F.col("value")).alias("value"), user.alias("user"), at.alias("at"), F.try_parse_json("props").alias("props"))
    return events.withColumn("record", F.to_json(record))


@query("""
WITH e AS (SELECT *, CAST(props->>'$.k' AS BIGINT) AS k, 'u' || user_id AS uid FROM events), v AS (
  SELECT event_id, '' AS path, 'required' AS keyword FROM e WHERE value < 1
  UNION ALL SELECT event_id, '/kind', 'enum' FROM e WHERE event_type = 'error'
  UNION ALL SELECT event_id, '/value', 'minimum' FROM e WHERE value >= 1 AND value < 2
  UNION ALL SELECT event_id, '/value', 'exclusiveMaximum' FROM e WHERE value >= 40
  UNION ALL SELECT event_id, '/value', 'maximum' FROM e WHERE value > 15 AND event_type = 'click'
  UNION ALL SELECT event_id, '/user/id', 'maxLength' FROM e WHERE length(uid) > 3 AND event_type <> 'click'
  UNION ALL SELECT event_id, '/user', 'additionalProperties' FROM e WHERE value > 100
  UNION ALL SELECT event_id, '/user/tags', 'uniqueItems' FROM e WHERE value > 60
  UNION ALL SELECT event_id, '/user/tags/0', 'enum' FROM e WHERE event_type IN ('purchase', 'error')
  UNION ALL SELECT event_id, '/user/tags/2', 'enum' FROM e WHERE event_type IN ('purchase', 'error') AND value > 60
  UNION ALL SELECT event_id, '/at', 'format' FROM e WHERE day(ts) = 1
  UNION ALL SELECT event_id, '/props/k', 'anyOf' FROM e WHERE k > 89 AND k <> 95)
SELECT event_id, path, keyword FROM v
""")
def schema_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every violation of a schema, with references between schemas, by the JSON records of all events."""
    return schemas.schema_violations(event_records(table(spark, sf_dir, "events")), ["event_id"], "record", EVENT_SCHEMA, {"common": USER_SCHEMA})


@query("""
WITH e AS (SELECT conv_id, 1 AS s, 2 AS e FROM conversations GROUP BY conv_id),
  w AS (SELECT e.conv_id, turn, role, text, false AS is_ahead FROM e JOIN conversations c ON c.conv_id = e.conv_id AND turn BETWEEN s AND e
        UNION ALL SELECT conv_id, min(turn), 'user', arg_min(text, turn), true FROM e JOIN conversations c USING (conv_id) WHERE turn > e AND role = 'user' AND trim(text) <> '' GROUP BY conv_id)
SELECT conv_id, turn, role, sha256(text) AS text_sha256, is_ahead FROM w
""")
def indexed_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations as raw JSON lines with an index of byte offsets; of each, turns 1 to 2 and the next user turn behind them, read by seek."""
    rows = table(spark, sf_dir, "conversations")
    folder = f"{byte_lines.shared_folder(spark)}/sessiongrain/raw-{uuid.uuid4().hex[:12]}"
    rows.select(F.to_json(F.struct("conv_id", "turn", "role", "text")).alias("value")).write.text(f"{folder}/lines")
    lines = byte_lines.read_byte_lines(spark, f"{folder}/lines", suffix=".txt")
    record = F.try_parse_json("value")
    at = lambda name, kind: F.try_variant_get(record, f"$.{name}", kind)
    byte_lines.write_index(lines, f"{folder}/index", conv_id=at("conv_id", "long"), turn=at("turn", "long"), real_user=(at("role", "string") == "user") & (F.trim(at("text", "string")) != ""))
    index = byte_lines.read_index(spark, f"{folder}/index")
    episodes = rows.select("conv_id").distinct().select("conv_id", F.lit(1).alias("start"), F.lit(2).alias("end"))
    got = byte_lines.fetch_lines(byte_lines.episode_lines(index, episodes, "conv_id", "turn", "real_user").select("conv_id", "turn", "is_ahead", "file", "size", "offset", "length"))
    return got.select("conv_id", "turn", at("role", "string").alias("role"), F.sha2(at("text", "string"), 256).alias("text_sha256"), "is_ahead")


@query(TURNS_SQL + """
SELECT user_id::VARCHAR AS trace_id, count(DISTINCT turn_id) AS n_turns, count(turn_id) AS n_turn_events, count(*) - count(turn_id) AS n_unassigned, count(*) AS n_sources,
  count(*) FILTER (turn_id IS NOT NULL AND event_type = 'error') AS n_errors, min(event_id) FILTER (turn_id IS NOT NULL) AS first_event
FROM (SELECT t.*, e.event_type FROM t JOIN events e USING (event_id)) GROUP BY user_id
""")
def workspace_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as a batch of products, written, checked and committed; what its turns and traces say of each trace, read back."""
    turned = opened_turns(table(spark, sf_dir, "events")).select(
        F.col("user_id").cast("string").alias("trace_id"), F.date_format("ts", "yyyy").alias("session_id"), F.col("turn_id").cast("string").alias("turn_id"), F.col("event_id").cast("string").alias("event_id"),
        F.col("event_id").alias("sequence"), F.col("event_type").alias("type"), F.col("props").alias("data"), F.date_format("ts", "yyyy-MM-dd").alias("input_file"), F.col("event_id").alias("record_index"),
    )
    events = workspace.source_ref(turned)
    turns = workspace.turn_product(events, "d", "b", {"n_errors": F.count_if(F.col("type") == "error")})
    sources = turned.select(F.col("input_file").alias("file"), "record_index", F.col("data").alias("record"))
    products = {"source_records": workspace.source_product(sources, "d", "b"), "lineage_edges": workspace.lineage_product(events, "d", "b"), "unified_turns": turns, "unified_traces": workspace.trace_product(events, turns, "d", "b")}
    path = f"{byte_lines.shared_folder(spark)}/sessiongrain/batch-{uuid.uuid4().hex[:12]}"
    n = turned.count()
    workspace.materialise(spark, products, path, {"dataset_id": "d", "batch_id": "b"}, "events", lambda at: workspace.coverage_errors(spark, at, n))
    read = spark.read.json(f"{path}/unified_turns")
    of_turns = read.groupBy("trace_id").agg(F.sum(F.size("events")).alias("n_turn_events"), F.sum(F.when(F.col("part") == 0, F.col("execution_context.n_errors"))).alias("n_errors"), F.min(F.array_min("events.sequence")).alias("first_event"))
    of_traces = spark.read.json(f"{path}/unified_traces").select("trace_id", F.explode("sessions").alias("s")).groupBy("trace_id").agg(F.sum(F.size("s.turn_refs")).alias("n_turns"), F.sum(F.size("s.unassigned_events")).alias("n_unassigned"))
    edges = spark.read.json(f"{path}/lineage_edges").join(turned.select("event_id", "trace_id"), "event_id").groupBy("trace_id").agg(F.count_distinct("source_record_id").alias("n_sources"))
    joined = of_traces.join(of_turns, "trace_id", "left").join(edges, "trace_id").na.fill(0, ["n_turn_events", "n_errors"])
    return joined.select("trace_id", "n_turns", "n_turn_events", "n_unassigned", "n_sources", "n_errors", "first_event")


def _small_context(system: str, user: str) -> tuple[dict, dict]:
    """A stand-in model with a small context: it takes 6,000 characters of texts at once and says how long each is."""
    items = json.loads(user)
    if sum(len(x["text"]) for x in items) > 6000:
        raise ValueError("context limit")
    return {"items": {x["id"]: len(x["text"]) for x in items}}, {}


@query("""
WITH RECURSIVE d AS (SELECT doc_id, length(text) AS n, lang || '/' || source AS s, row_number() OVER (PARTITION BY lang, source ORDER BY doc_id) - 1 AS r FROM documents),
c AS (SELECT *, sum(n) OVER (PARTITION BY s ORDER BY r) AS upto FROM d),
p AS (SELECT s, r // 8 AS k, min(r) AS lo, max(r) AS hi, 0 AS depth FROM d GROUP BY s, r // 8
  UNION ALL
  SELECT s, k, CASE WHEN side = 0 THEN lo ELSE lo + (hi - lo) // 2 + 1 END, CASE WHEN side = 0 THEN lo + (hi - lo) // 2 ELSE hi END, depth + 1
  FROM (SELECT p.*, a.upto - b.upto + b.n AS total FROM p JOIN c a ON a.s = p.s AND a.r = p.hi JOIN c b ON b.s = p.s AND b.r = p.lo), (VALUES (0), (1)) AS sides(side) WHERE total > 6000 AND hi > lo AND depth < 3),
last AS (SELECT s, r, max(depth) AS depth FROM d JOIN p USING (s) WHERE r BETWEEN lo AND hi GROUP BY s, r),
whole AS (SELECT l.*, a.upto - b.upto + b.n AS total FROM last l JOIN p ON p.s = l.s AND p.depth = l.depth AND l.r BETWEEN p.lo AND p.hi JOIN c a ON a.s = p.s AND a.r = p.hi JOIN c b ON b.s = p.s AND b.r = p.lo)
SELECT doc_id::VARCHAR AS id, w.depth::INTEGER AS depth, CASE WHEN total <= 6000 THEN n::VARCHAR END AS answer, CASE WHEN total > 6000 THEN 'ValueError: context limit' END AS error FROM whole w JOIN d USING (s, r)
""")
def subdivided_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in partitions of eight of one language and source, split while the model's context does not take them."""
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy("doc_id")) - 1
    d = table(spark, sf_dir, "documents").select("doc_id", "text", F.concat_ws("/", "lang", "source", F.floor(place / 8).cast("string")).alias("part"))
    return worklist.subdivide(d, _small_context, "judge", "part", "doc_id", "doc_id", "text").select("id", "depth", "answer", "error")


def _careless(system: str, user: str) -> tuple[dict, dict]:
    """A stand-in model that pairs turns up and, by the number of characters that it is shown, makes mistakes; some of them again when told."""
    asked = json.loads(user)
    ids = [t["turn_id"] for t in asked["turns"]]
    n = len(ids)
    fault = sum(len(t["content"]) for t in asked["turns"]) % 7
    if "validation_issues" in asked and not (fault == 2 or fault == 4 and n % 2):
        fault = 0
    pairs = [(i, min(i + 1, n - 1)) for i in range(0, n, 2)]
    if fault == 1:
        pairs.pop()
    if fault == 2:
        pairs[0] = (0, n - 1)
    if fault == 3:
        return {"task_episodes": "none"}, {}
    if fault == 5:
        raise ValueError("busy")
    episodes = [{"episode_boundary": {"judgment": "reliable", "start_turn_id": ids[a], "end_turn_id": ids[b]}, "initial_query": {"judgment": "identified", "turn_id": ids[a]}} for a, b in pairs]
    if fault == 4:
        episodes[0]["initial_query"]["turn_id"] = "nowhere"
    return {"task_episodes": episodes}, {}


@query("""
WITH u AS (SELECT conv_id, conv_id || '#' || turn AS id, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS p FROM conversations WHERE role = 'user'),
t AS (SELECT conv_id, count(*) AS n, sum(length(text)) % 7 AS fault, list(id ORDER BY p) AS ids FROM u GROUP BY conv_id),
f AS (SELECT *, CASE WHEN fault = 1 AND n <= 2 THEN 'structural:task_episodes_empty'
    WHEN fault = 1 THEN 'structural:uncovered_turns:' || (2 - n % 2) || ':' || array_to_string(ids[n - 1 + n % 2:], ',')
    WHEN fault = 2 AND n > 2 THEN 'structural:overlap_turns:' || (n - 2) || ':' || array_to_string(ids[3:14], ',')
    WHEN fault = 3 THEN 'structural:task_episodes_not_array' WHEN fault = 4 THEN 'structural:episode_0:identified_query_unknown'
    WHEN fault = 5 THEN 'structural:call_failed:ValueError: busy' END AS issue FROM t),
g AS (SELECT *, issue IS NOT NULL AND (fault = 2 OR (fault = 4 AND n % 2 = 1)) AS whole FROM f),
e AS (SELECT *, unnest(CASE WHEN whole THEN [0] ELSE range(0, n, 2) END) AS a FROM g)
SELECT conv_id, (a // 2)::INTEGER AS ord, ids[a + 1] AS start_turn_id, CASE WHEN whole THEN ids[n] ELSE ids[least(a + 2, n)] END AS end_turn_id,
  CASE WHEN NOT whole THEN ids[a + 1] END AS query_turn_id, CASE WHEN whole THEN 'uncertain' ELSE 'reliable' END AS boundary,
  CASE WHEN whole THEN 'fallback' WHEN issue IS NULL THEN 'screened' ELSE 'repaired' END AS strategy, coalesce(issue, '') AS initial_issue, CASE WHEN whole THEN issue ELSE '' END AS final_issue FROM e
""")
def repaired_boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Episodes of the user turns of all conversations, by a model whose mistakes are found, sent back once, and replaced where they stay."""
    u = table(spark, sf_dir, "conversations").where("role = 'user'").select("conv_id", F.concat_ws("#", "conv_id", "turn").alias("turn_id"), F.col("turn").alias("pos"), F.col("text").alias("content"))
    got = boundaries.screen_boundaries(u, _careless, "judge", "repair", "conv_id")
    return got.select("conv_id", "ord", "start_turn_id", "end_turn_id", "query_turn_id", "boundary", "strategy", F.array_join("initial_issues", "|").alias("initial_issue"), F.array_join("final_issues", "|").alias("final_issue"))


@query("""
WITH e AS (SELECT 'c' || c_custkey AS p, 'o' || o_orderkey AS c FROM customer JOIN orders ON o_custkey = c_custkey
  UNION ALL SELECT 'o' || l_orderkey, 'l' || l_orderkey || '.' || l_linenumber FROM lineitem UNION ALL SELECT 's' || l_suppkey, 'l' || l_orderkey || '.' || l_linenumber FROM lineitem),
z AS (SELECT 'c' || c_custkey AS id, 'changed' AS cause FROM customer WHERE c_acctbal < 0 UNION ALL SELECT 's' || s_suppkey, 'removed' FROM supplier WHERE s_acctbal < 0),
a AS (SELECT DISTINCT c AS id FROM e JOIN z ON p = id), b AS (SELECT DISTINCT c AS id FROM e JOIN a ON p = id WHERE c NOT IN (SELECT id FROM a))
SELECT id, 0 AS depth, cause FROM z UNION ALL SELECT id, 1, 'descendant' FROM a UNION ALL SELECT id, 2, 'descendant' FROM b
""")
def stale_descendants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What descends from customers whose balance is set to zero and from suppliers that go: their orders and lines, and nothing else."""
    customers, orders, lines = (table(spark, sf_dir, t) for t in ("customer", "orders", "lineitem"))
    name = lambda letter, *columns: F.concat(F.lit(letter), F.concat_ws(".", *columns))
    edge = lambda df, parent, child: df.select(parent.alias("parent_id"), child.alias("child_id"))
    line = name("l", "l_orderkey", "l_linenumber")
    edges = edge(orders, name("c", "o_custkey"), name("o", "o_orderkey")).unionByName(edge(lines, name("o", "l_orderkey"), line)).unionByName(edge(lines, name("s", "l_suppkey"), line))
    suppliers = table(spark, sf_dir, "supplier")
    prints = lambda c, s: c.select(name("c", "c_custkey").alias("id"), F.sha2(F.col("c_acctbal").cast("string"), 256).alias("digest")).unionByName(s.select(name("s", "s_suppkey").alias("id"), F.sha2(F.col("s_acctbal").cast("string"), 256).alias("digest")))
    mended = customers.withColumn("c_acctbal", F.when(F.col("c_acctbal") < 0, F.lit(0).cast(customers.schema["c_acctbal"].dataType)).otherwise(F.col("c_acctbal")))
    return reanalysis.stale(edges, prints(customers, suppliers), prints(mended, suppliers.where("s_acctbal >= 0")))


def _failing_on(multiple: int):
    """A stand-in model that fails of requests whose number is a multiple."""

    def judge(system: str, user: str) -> tuple[dict, dict]:
        if int(user) % multiple == 0:
            raise RuntimeError("no answer")
        return {"events": int(user)}, {}

    return judge


@query("""
WITH u AS (SELECT strftime(ts, '%Y-%m-%d') AS batch_id, user_id, count(*) AS n, bool_or(event_type = 'error') AS bad, arg_max(event_type, event_id) FILTER (event_type IN ('purchase', 'signup')) AS said FROM events GROUP BY ALL)
SELECT batch_id, count(*) AS n_traces, count(*) AS n_items, count(*) FILTER (n % 6 <> 0) AS n_completed, count(*) FILTER (n % 6 = 0) AS n_failed,
  CASE WHEN count(*) FILTER (n % 6 = 0) = 0 THEN 'completed' ELSE 'partial' END AS status FROM u WHERE bad AND said = 'purchase' GROUP BY batch_id
""")
def reanalysis_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users with errors on a day, queued and approved by their last word, prepared and executed; run again for what failed at first."""
    e = table(spark, sf_dir, "events").withColumns({"batch_id": F.date_format("ts", "yyyy-MM-dd"), "run_id": F.lit("base"), "trace_id": F.col("user_id").cast("string")})
    e = e.withColumn("queue_id", F.concat_ws("/", "batch_id", "trace_id"))
    keys = ["batch_id", "run_id", "trace_id"]
    queue = e.where("event_type = 'error'").select("queue_id", *keys, F.lit(reanalysis.MODE).alias("mode")).distinct()
    said = e.where("event_type IN ('purchase', 'signup')").select("queue_id", F.when(F.col("event_type") == "purchase", "approved").otherwise("rejected").alias("decision"), F.col("event_id").alias("created_at"))
    prepared = reanalysis.prepare_reanalysis(queue, said, e.groupBy(*keys).agg(F.count("*").alias("n")), "cycle")
    first = reanalysis.execute_reanalysis(prepared, _failing_on(3), "verify", "n")
    second = reanalysis.execute_reanalysis(prepared, _failing_on(6), "verify", "n", first.results)
    return second.jobs.select("batch_id", "n_traces", "n_items", "n_completed", "n_failed", "status")


@query("""
WITH c AS (SELECT source, arg_max(lang, (n, lang)) AS lang FROM (SELECT source, lang, count(*) AS n FROM documents GROUP BY ALL) GROUP BY source),
d AS (SELECT source, lang, text FROM documents JOIN c USING (source, lang)), v AS (
SELECT 'model' AS kind, lang AS value FROM d UNION ALL SELECT 'harness', source FROM d UNION ALL SELECT 'gap', unnest(list_distinct(string_split(text, ' '))) FROM d)
SELECT kind, value, count(*) AS case_count FROM v GROUP BY kind, value
""")
def global_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources as batches with a run a language: indexes of the active runs, brought up to date from parts that were right for other active runs."""
    d = table(spark, sf_dir, "documents")
    index = d.select(F.col("source").alias("batch_id"), F.col("lang").alias("run_id"), F.lit("confirmed").alias("judgment"), F.array("lang").alias("models"), F.array("source").alias("harnesses"), F.array_distinct(F.split("text", " ")).alias("gaps"))
    sizes = d.groupBy("source", "lang").agg(F.count("*").alias("n")).groupBy(F.col("source").alias("batch_id"))
    before = sizes.agg(F.max("lang").alias("active_run"))
    now = sizes.agg(F.max_by("lang", F.struct("n", "lang")).alias("active_run"))
    return reanalysis.global_indexes(reanalysis.rebuilt_parts(reanalysis.index_parts(index, before), index, now))


@query("""
WITH q AS (SELECT doc_id, text, substr(text, 5, 20) || '~' || substr(text, 31, 30) AS quote FROM documents),
w AS (SELECT doc_id, text, quote, unnest(range(1, length(quote) + 1)) AS i FROM q),
l AS (SELECT doc_id, text, quote, i, coalesce(list_max([n FOR n IN range(1, length(quote) - i + 2) IF contains(text, substr(quote, i, n))]), 0) AS n FROM w),
b AS (SELECT doc_id, any_value(text) AS text, any_value(quote) AS quote, max(n) AS n, arg_max(i, (n, -i)) AS i FROM l GROUP BY doc_id),
p AS (SELECT *, instr(text, substr(quote, i, n)) AS s FROM b WHERE NOT contains(text, quote))
SELECT doc_id, 'quote_not_exact; closest passage: ' || substr(text, greatest(s - 80, 1), s - greatest(s - 80, 1) + n + 80) AS feedback FROM p WHERE n > 0
UNION ALL SELECT doc_id, 'quote_not_exact; nothing of it is in the source' FROM p WHERE n = 0
""")
def quote_feedback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quote of each document that leaves some of it out, and what a model is told about it."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    quotes = d.select("doc_id", F.concat(F.substring("text", 5, 20), F.lit("~"), F.substring("text", 31, 30)).alias("quote"))
    return evidence.citation_feedback(quotes, d, "doc_id", "quote", "text").select("doc_id", "feedback")
