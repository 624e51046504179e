"""Queries of turn products, selections and the model client, with SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessiongrain.operators import products, selections, sessions
from sessiongrain.plans import client
from sessiongrain.plans.queries import query, table


@query("""
SELECT event_id, event_type, user_id, min(day)::VARCHAR AS input_file, min(event_id) AS record_index
FROM (SELECT event_id, event_type, user_id, strftime(ts, '%Y-%m-%d') AS day FROM events) GROUP BY ALL
""")
def event_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    sources = e.select("event_id", F.date_format("ts", "yyyy-MM-dd").alias("input_file"), F.col("event_id").alias("record_index"))
    found = products.event_references(e, sources, ["event_type", "user_id"])
    return found.select("event_id", "event_type", "user_id", "source_ref.input_file", "source_ref.record_index")


@query("SELECT event_id, event_type AS type, length(props) AS n_chars, sha256(props) AS sha256 FROM events")
def event_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", products.event_projection(F.col("event_type"), F.col("props")).alias("p")).select("event_id", "p.type", F.col("p.n_chars").cast("long").alias("n_chars"), "p.sha256")


@query("""
SELECT user_id, day, count(*) FILTER (WHERE c) AS n_calls, coalesce(string_agg(DISTINCT tool, ',' ORDER BY tool) FILTER (WHERE c), '') AS tools, count(*) FILTER (WHERE event_type = 'error') AS n_errors,
  coalesce(bool_and(CASE WHEN c THEN tool IS NOT NULL END), false) AS complete
FROM (SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, event_type, event_type = 'click' AS c, CASE WHEN value >= 3 THEN 't' || (CAST(floor(value) AS BIGINT) % 7) END AS tool FROM events) GROUP BY user_id, day
""")
def execution_contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tool = F.when(F.col("value") >= 3, F.concat(F.lit("t"), (F.floor("value") % 7).cast("string")))
    e = table(spark, sf_dir, "events").withColumn("day", F.date_format("ts", "yyyy-MM-dd")).withColumn("tool", tool)
    found = products.execution_contexts(e, ["user_id", "day"], "tool", "event_type", F.col("event_type") == "click", F.col("event_type") == "error")
    return found.select("user_id", "day", "n_calls", F.array_join("tools", ",").alias("tools"), "n_errors", "complete")


@query("""
WITH c AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_discount > 0.03 THEN l_returnflag END AS model FROM lineitem),
w AS (SELECT l_orderkey, min(model) AS lo, max(model) AS hi FROM c GROUP BY l_orderkey), o AS (SELECT l_orderkey, l_linenumber, string_agg(DISTINCT model, ',' ORDER BY model) AS own FROM c GROUP BY ALL)
SELECT o.l_orderkey, o.l_linenumber, coalesce(own, CASE WHEN lo = hi THEN lo END, '') AS models, own IS NULL AND coalesce(lo = hi, false) AS inferred FROM o JOIN w USING (l_orderkey)
""")
def turn_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.when(F.col("l_discount") > 0.03, F.col("l_returnflag")).alias("model"))
    found = products.turn_models(calls, "l_orderkey", "l_linenumber", "model")
    return found.select("l_orderkey", "l_linenumber", F.array_join("models", ",").alias("models"), "inferred")


@query("SELECT event_id, CAST(props->>'$.k' AS BIGINT) AS tokens FROM events")
def usage_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", products.usage_total(F.col("props"), ("k", "output_tokens")).alias("tokens"))


@query("""
WITH e AS (SELECT coalesce(event_type, '') || '/' || coalesce(strftime(ts, '%Y-%m-%d'), '') AS file, event_id, user_id, trim(coalesce(props, '')) = '' AS blank FROM events),
n AS (SELECT *, row_number() OVER w AS line, count(*) FILTER (NOT blank) OVER w - 1 AS record, first_value(event_id) OVER w AS first_event, first_value(user_id) OVER w AS first_user
  FROM e WINDOW w AS (PARTITION BY file ORDER BY event_id NULLS LAST ROWS UNBOUNDED PRECEDING))
SELECT file, event_id, line, record, first_event, first_user FROM n WHERE NOT blank
""")
def source_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events of one type and day are the lines of a file: where each turn stands in it, and the event and user of its first line."""
    file = F.concat(F.coalesce("event_type", F.lit("")), F.lit("/"), F.coalesce(F.date_format("ts", "yyyy-MM-dd"), F.lit("")))
    e = table(spark, sf_dir, "events").select(file.alias("file"), "event_id", "user_id", (F.trim(F.coalesce("props", F.lit(""))) == "").alias("blank"))
    lines = products.numbered_lines(e, "file", "event_id", F.col("blank"))
    first = e.groupBy("file").agg(F.min("event_id").alias("first_event"), F.min_by("user_id", "event_id").alias("first_user"))
    return products.source_locations(lines, "file", "event_id", "line", "record").join(first, "file")


@query("""
SELECT user_id, sum(CAST(props->>'$.k' AS BIGINT))::BIGINT AS prompt_tokens, sum(CAST(floor(value) AS BIGINT)) FILTER (value >= 5)::BIGINT AS completion_tokens,
  sum(CAST(props->>'$.k' AS BIGINT)) FILTER (event_type <> 'error')::BIGINT AS total_tokens FROM events GROUP BY user_id
""")
def usage_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reported counts per user, of which some events lack one and some report no number."""
    k = F.get_json_object("props", "$.k")
    total = F.when(F.col("event_type") == "error", "unknown").otherwise(k)
    e = table(spark, sf_dir, "events").withColumn("usage", F.to_json(F.struct(k.cast("long").alias("prompt_tokens"), F.when(F.col("value") >= 5, F.floor("value")).alias("completion_tokens"), total.alias("total_tokens"))))
    return products.usage_sums(e, "usage", ["user_id"])


@query("""
WITH c AS (SELECT user_id, min(event_id) AS "start", max(event_id) AS "end" FROM events WHERE event_type = 'purchase' GROUP BY user_id)
SELECT c.user_id, e.event_id FROM c JOIN events AS e ON e.user_id = c.user_id WHERE e.event_type = 'error' AND e.event_id BETWEEN c."start" AND c."end"
""")
def interruptions_within(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    cases = e.where("event_type = 'purchase'").groupBy("user_id").agg(F.min("event_id").alias("start"), F.max("event_id").alias("end"))
    return products.interruptions_within(cases, e.where("event_type = 'error'").select("user_id", "event_id"), "user_id", "event_id").select("user_id", "event_id")


@query("SELECT doc_id, source FROM documents ORDER BY source, doc_id LIMIT 120")
def first_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return products.first_records(table(spark, sf_dir, "documents").select("doc_id", "source"), ["source", "doc_id"], 120)


@query("""
SELECT conv_id, turn, coalesce(sum(strlen(text) + 1) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS "offset", strlen(text)::BIGINT AS length FROM conversations
""")
def line_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = products.line_index(table(spark, sf_dir, "conversations"), "conv_id", "turn", "text")
    return found.select("conv_id", "turn", F.col("offset").cast("long").alias("offset"), F.col("length").cast("long").alias("length"))


@query("""
WITH p AS (SELECT conv_id, min(turn) FILTER (WHERE role = 'user') AS "start", min(turn) FILTER (WHERE role = 'assistant') AS "end" FROM conversations GROUP BY conv_id)
SELECT c.conv_id, c.turn, c.turn > p."end" AS is_ahead FROM p JOIN conversations AS c USING (conv_id) WHERE c.turn >= p."start" AND c.turn <= p."end" + 2
""")
def episode_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    first = lambda role: F.min(F.when(F.col("role") == role, F.col("turn")))
    episodes = c.groupBy("conv_id").agg(first("user").alias("start"), first("assistant").alias("end"))
    return products.episode_rows(c, episodes, "conv_id", "turn", 2).select("conv_id", "turn", "is_ahead")


@query("""
SELECT doc_id, concat_ws(',', CASE WHEN NOT (lang IN ('en', 'de')) THEN 'lang' END, CASE WHEN NOT (n_chars >= 500) THEN 'length' END, CASE WHEN NOT coalesce(quality = 0 OR toxic = 0, false) THEN 'gate' END) AS issues
FROM documents LEFT JOIN labels USING (doc_id)
""")
def semantic_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    checks = {"lang": selections.one_of(F.col("lang"), ("en", "de")), "length": F.col("n_chars") >= 500, "gate": (F.col("quality") == 0) | (F.col("toxic") == 0)}
    return d.select("doc_id", F.array_join(selections.semantic_issues(checks), ",").alias("issues"))


@query("""
SELECT c_custkey, CASE WHEN n_name IS NOT NULL THEN c_nationkey || ' ' || n_name ELSE 'unknown (' || c_nationkey || ')' END AS nation
FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_regionkey < 3) ON n_nationkey = c_nationkey
""")
def readable_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "nation").where("n_regionkey < 3").withColumnRenamed("n_nationkey", "c_nationkey")
    return selections.readable_names(table(spark, sf_dir, "customer"), names, "c_nationkey", "n_name", "nation").select("c_custkey", "nation")


@query("""
SELECT o_orderkey AS claim, coalesce(CASE WHEN o_orderstatus <> 'O' THEN o_orderstatus END, 'unreviewed') AS support, count(DISTINCT l_partkey) AS n_evidence, coalesce(string_agg(DISTINCT l_partkey, ',' ORDER BY l_partkey), '') AS events
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey WHERE o_totalprice > 100000 GROUP BY o_orderkey, o_orderstatus
""")
def reference_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    claims = table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "claim")
    cited = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("claim"), "l_partkey")
    found = selections.reference_catalog(claims, cited, "claim", F.col("o_totalprice") > 100000, F.when(F.col("o_orderstatus") != "O", F.col("o_orderstatus")), "l_partkey")
    return found.select("claim", "support", F.col("n_evidence").cast("long").alias("n_evidence"), F.array_join("events", ",").alias("events"))


@query("SELECT l_orderkey, bool_and(l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)) AS within FROM lineitem GROUP BY l_orderkey")
def groups_within(spark: SparkSession, sf_dir: str) -> DataFrame:
    allowed = table(spark, sf_dir, "supplier").where("s_acctbal > 0").select(F.col("s_suppkey").alias("l_suppkey"))
    return selections.groups_within(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_suppkey", allowed)


@query("""
SELECT o_orderpriority, count(*) FILTER (WHERE a) AS n_least, count(*) FILTER (WHERE b) AS n_most
FROM (SELECT o_orderpriority, o_custkey, bool_and(o_orderstatus = 'F') AS a, bool_or(o_orderstatus = 'F') AS b FROM orders GROUP BY ALL) GROUP BY ALL
""")
def duplicate_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selections.duplicate_bounds(table(spark, sf_dir, "orders"), "o_orderpriority", "o_custkey", F.col("o_orderstatus") == "F")


@query("SELECT l_orderkey, count(DISTINCT l_suppkey) AS n_missing FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0) GROUP BY l_orderkey")
def missing_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    published = table(spark, sf_dir, "supplier").where("s_acctbal > 0").select(F.col("s_suppkey").alias("l_suppkey"))
    return selections.missing_published(table(spark, sf_dir, "lineitem"), published, "l_orderkey", "l_suppkey")


@query("SELECT doc_id FROM labels WHERE quality = 0 AND CASE toxic WHEN 1 THEN 'negative' ELSE 'neutral' END IN ('negative', 'mixed')")
def negative_feedback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selections.negative_feedback(table(spark, sf_dir, "labels"), F.col("quality") == 0, F.when(F.col("toxic") == 1, "negative").otherwise("neutral")).select("doc_id")


@query("SELECT o_orderkey FROM orders SEMI JOIN (SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'F' ELSE 'O' END AS s FROM customer) ON c_custkey = o_custkey AND s = o_orderstatus")
def audit_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    audits = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), F.when(F.col("c_acctbal") < 0, "F").otherwise("O").alias("o_orderstatus"))
    return selections.matching(table(spark, sf_dir, "orders"), audits, ["o_custkey", "o_orderstatus"]).select("o_orderkey")


@query("""
WITH c AS (SELECT doc_id, toxic, n_chars, coalesce(toxic = 1, false) AS p FROM labels JOIN documents USING (doc_id)),
r AS (SELECT *, row_number() OVER (PARTITION BY p ORDER BY n_chars, doc_id) - 1 AS pos, count(*) OVER (PARTITION BY p) AS n, least(count(*) FILTER (p) OVER (), 30) AS kp FROM c),
q AS (SELECT *, CASE WHEN p THEN kp ELSE least(n, 60 - kp) END AS k FROM r)
SELECT doc_id, toxic, n_chars FROM q WHERE k >= n OR (k = 1 AND pos = n // 2) OR (k > 1 AND list_contains(list_transform(range(k), lambda i: CAST(round_even(i * (n - 1) / (k - 1)::DOUBLE, 0) AS BIGINT)), pos))
""")
def balanced_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", "n_chars"), "doc_id")
    return selections.balanced_sample(rows, F.col("toxic") == 1, "doc_id", "n_chars", 60).select("doc_id", "toxic", "n_chars")


@query("""
SELECT kind, doc_id FROM (SELECT kind, doc_id, row_number() OVER (PARTITION BY kind ORDER BY doc_id) AS r
FROM (SELECT doc_id, CASE WHEN quality = 1 THEN 'positive' WHEN toxic = 1 THEN 'negative' END AS kind FROM labels) WHERE kind IS NOT NULL) WHERE r <= 3
""")
def fixed_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("quality") == 1, "positive").when(F.col("toxic") == 1, "negative")
    return selections.fixed_examples(table(spark, sf_dir, "labels"), kind, "doc_id").select("kind", "doc_id")


@query("SELECT 'lang' AS field, lang AS value, count(*) AS n FROM documents WHERE lang <> '' GROUP BY ALL UNION ALL SELECT 'source', source, count(*) FROM documents WHERE source <> '' GROUP BY ALL")
def facet_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selections.facet_options(table(spark, sf_dir, "documents"), ["lang", "source"])


@query("""
WITH s AS (SELECT s_suppkey, s_nationkey FROM supplier WHERE contains(lower(s_name), '7')), n AS (SELECT DISTINCT n_nationkey, n_regionkey FROM nation JOIN s ON s_nationkey = n_nationkey)
SELECT 's' || s_suppkey AS id FROM s UNION SELECT 'n' || n_nationkey FROM n UNION SELECT 'r' || n_regionkey FROM n
""")
def tree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = lambda letter, c: F.concat(F.lit(letter), F.col(c).cast("string"))
    leaves = table(spark, sf_dir, "supplier").select(name("s", "s_suppkey").alias("id"), name("n", "s_nationkey").alias("parent"), F.col("s_name").alias("text"))
    inner = table(spark, sf_dir, "nation").select(name("n", "n_nationkey").alias("id"), name("r", "n_regionkey").alias("parent"), F.lit("").alias("text"))
    roots = table(spark, sf_dir, "region").select(name("r", "r_regionkey").alias("id"), F.lit(None).cast("string").alias("parent"), F.lit("").alias("text"))
    return selections.tree_search(leaves.unionByName(inner).unionByName(roots), "text", "7")


@query("""
SELECT digest, count(*) AS n, min(o_custkey) AS "first" FROM (SELECT o_custkey, sha256(string_agg(o_orderpriority, chr(10) ORDER BY o_orderkey)) AS digest FROM orders GROUP BY o_custkey) GROUP BY digest
""")
def same_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selections.same_queries(table(spark, sf_dir, "orders"), "o_custkey", "o_orderkey", "o_orderpriority")


@query("""
WITH t AS (SELECT o_orderpriority, o_custkey, min(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'P' THEN 2 ELSE 3 END) AS r FROM orders GROUP BY ALL)
SELECT o_orderpriority, count(*) AS n_traces, count(*) FILTER (WHERE r = 1) AS "n_F", count(*) FILTER (WHERE r = 2) AS "n_P", count(*) FILTER (WHERE r = 3) AS "n_O" FROM t GROUP BY ALL
""")
def status_by_trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selections.status_by_trace(table(spark, sf_dir, "orders"), "o_orderpriority", "o_custkey", "o_orderstatus", ("F", "P", "O"))


@query("""
WITH r AS (SELECT p_type, p_brand, l_orderkey AS c FROM lineitem JOIN part ON p_partkey = l_partkey), t AS (SELECT count(DISTINCT c) AS total FROM r),
s AS (SELECT p_type, p_brand, count(DISTINCT c) AS n FROM r GROUP BY ALL), x AS (SELECT s.*, n < 0.055 * total AS rare FROM s, t),
k AS (SELECT r.p_type, count(DISTINCT c) AS n_kept_cases FROM r JOIN x ON x.p_type = r.p_type AND x.p_brand = r.p_brand AND NOT rare GROUP BY r.p_type)
SELECT x.p_type, count(*) AS n_children, count(*) FILTER (WHERE rare) AS n_rare, coalesce(any_value(k.n_kept_cases), 0) AS n_kept_cases, greatest(count(*) FILTER (WHERE rare) - 1, 0) AS net_reduction
FROM x LEFT JOIN k ON k.p_type = x.p_type GROUP BY x.p_type
""")
def compression_draft(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), F.col("p_partkey") == F.col("l_partkey")).select("p_type", "p_brand", F.col("l_orderkey").alias("c"))
    return selections.compression_draft(rows, "p_type", "p_brand", "c", 0.055)


@query("SELECT count(*) AS n_events, max(event_id) AS max_sequence FROM events")
def review_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selections.watermark(table(spark, sf_dir, "events"), "event_id")


@query("""
WITH n AS (SELECT o_orderkey, sha256(o_orderstatus || '|' || o_custkey) AS digest FROM orders), s AS (SELECT o_orderkey, sha256('F|' || o_custkey) AS d FROM orders WHERE o_totalprice > 50000)
SELECT n.o_orderkey, digest, d IS NULL OR d <> digest AS changed FROM n LEFT JOIN s USING (o_orderkey)
""")
def review_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    stored = o.where("o_totalprice > 50000").select("o_orderkey", F.sha2(F.concat(F.lit("F|"), F.col("o_custkey").cast("string")), 256).alias("digest"))
    return selections.synced(o, stored, "o_orderkey", ["o_orderstatus", "o_custkey"])


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size < 25)")
def migrated_audits(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_name").alias("definition"))
    new = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), F.when(F.col("p_size") < 25, F.col("p_name")).otherwise("changed").alias("definition"))
    return selections.migrated_audits(table(spark, sf_dir, "lineitem"), old, new, "l_partkey", "definition").select("l_orderkey", "l_linenumber")


@query("SELECT c_custkey, regexp_replace(c_name || '@' || c_mktsegment, '@[^@]*$', '') AS name, length('{\"k\":' || c_custkey || ',\"n\":\"' || c_name || '\"}')::INTEGER AS chars FROM customer")
def clean_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", selections.clean_name(F.concat_ws("@", "c_name", "c_mktsegment")).alias("name"), selections.payload_chars(F.col("c_custkey").alias("k"), F.col("c_name").alias("n")).alias("chars"))


@query("""
WITH said AS (SELECT DISTINCT o_custkey, CAST(floor(o_totalprice / 100) AS BIGINT)::VARCHAR AS value FROM orders),
done AS (SELECT o_custkey, 'STATUS_' || o_orderstatus AS name, CAST(floor(o_totalprice / 100) AS BIGINT)::VARCHAR AS value FROM orders
  UNION SELECT o_custkey, 'FLAG_' || l_returnflag, CAST(floor(l_extendedprice / 100) AS BIGINT)::VARCHAR FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT o_custkey, name, value FROM done SEMI JOIN said USING (o_custkey, value) WHERE regexp_full_match(value, '[0-9]{3,}') AND regexp_full_match(name, '[A-Z][A-Z0-9_]{2,}')
""")
def stated_settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order is a user message that states its total and a tool result that sets it; every line of a customer's orders is a tool result too."""
    hundreds = lambda c: F.floor(F.col(c) / 100).cast("string")
    sets = lambda kind, flag, v: F.concat(F.lit(f"set {kind}_"), flag, F.lit(" = \""), v, F.lit(f"\" and {kind.lower()}="), v)
    o = table(spark, sf_dir, "orders").withColumn("v", hundreds("o_totalprice"))
    lines = table(spark, sf_dir, "lineitem").join(o.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    done = o.select("o_custkey", sets("STATUS", "o_orderstatus", "v").alias("text"))
    done = done.unionByName(lines.select("o_custkey", sets("FLAG", "l_returnflag", hundreds("l_extendedprice")).alias("text")))
    said = o.select("o_custkey", F.concat(F.lit("please use "), "v", F.lit(" here")).alias("text"))
    return selections.stated_settings(said, done, "o_custkey", "text")


def _sometimes_away(system: str, user: str) -> tuple[dict, dict]:
    """Unavailable for one customer in four, too long for one in five until the budget is small, misspelt keys for the others."""
    number, budget = int(user.split()[0]), int(user.split("most output tokens: ")[1].rstrip("]"))
    if number % 4 == 3:
        raise client.Unavailable
    if number % 5 == 2 and budget > 2048:
        raise client.TooLong
    return ({"atribution": ["agent"]} if number % 3 or "not valid" in user else {"attribution": []}), {}


@query("""
SELECT c_custkey, CASE WHEN c_custkey % 4 = 3 THEN NULL ELSE '{"attribution": ["agent"]}' END AS answer, CASE WHEN c_custkey % 4 = 3 THEN 'service unavailable' END AS error,
  (CASE WHEN c_custkey % 4 = 3 THEN 1 ELSE 1 + CASE WHEN c_custkey % 5 = 2 THEN 2 ELSE 0 END + CASE WHEN c_custkey % 3 = 0 THEN 1 ELSE 0 END END)::INTEGER AS attempts,
  (CASE WHEN c_custkey % 4 <> 3 AND c_custkey % 5 = 2 THEN 2048 ELSE 8192 END)::INTEGER AS budget, CASE WHEN c_custkey % 4 = 3 THEN 180.0 ELSE 0.0 END::DOUBLE AS waited
FROM customer
""")
def client_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The client layer around a stand-in model: back-off, context limit, key repair and feedback, one row a request."""
    requests = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_custkey").cast("string").alias("prompt"))
    check = lambda v: None if v.get("attribution") else "attribution must not be empty"
    return client.ask_rows(requests, [_sometimes_away], "judge", check, "c_custkey", known=("attribution",))


@query("""
WITH q AS (SELECT doc_id, substr(text, 3, 12) AS quote FROM documents WHERE length(text) > 20), b AS (SELECT q.doc_id, quote, instr(text, quote) AS pos, text FROM q JOIN documents USING (doc_id))
SELECT doc_id, CASE WHEN pos > 0 AND instr(substr(text, pos + 1), quote) = 0 THEN pos - 1 ELSE -1 END::INTEGER AS "start" FROM b
""")
def exact_locators(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    quotes = d.where(F.length("text") > 20).select("doc_id", F.substring("text", 3, 12).alias("quote"))
    return client.exact_locators(quotes, d, "doc_id").select("doc_id", F.coalesce("start", F.lit(-1)).alias("start"))


@query("""
WITH u AS (SELECT conv_id, turn, trim(text, ' ' || chr(10)) AS t FROM conversations WHERE role = 'user')
SELECT conv_id, count(*) AS n_real FROM u WHERE t <> '' AND NOT (starts_with(t, 'Base directory for this skill:') OR starts_with(t, '[System reminder] This is a runtime system reminder, not user input.') OR starts_with(t, '<task-notification>')
  OR starts_with(t, 'Resume from the paused agent session. The working directory is unchanged.') OR starts_with(t, '[Request interrupted by user') OR starts_with(t, 'The previous request encountered a temporary API error.')
  OR starts_with(t, 'This session is being continued from a previous conversation that ran out of context.') OR starts_with(t, '[system] Previously read image bytes have been cleared')
  OR starts_with(t, '[User message] The previous PDF parsing attempt already failed')) GROUP BY conv_id
""")
def real_user_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turns that a person wrote, per conversation."""
    c = table(spark, sf_dir, "conversations").where("role = 'user'").withColumn("t", F.trim(F.col("text"), F.lit(" \n")))
    return c.where((F.col("t") != "") & ~sessions.starts_with_any(F.col("t"), sessions.SYNTHETIC_PREFIXES)).groupBy("conv_id").agg(F.count("*").alias("n_real"))
