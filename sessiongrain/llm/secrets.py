"""Secret scans: Boolean trigram queries over an inverted index, candidates verified by the rules' patterns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sessiongrain.llm.common import ROW, cut, let, read_table, with_row_id

try:  # the parser's place since Python 3.11
    from re import _constants as sre
    from re import _parser as sre_parse
except ImportError:  # pragma: no cover
    import sre_constants as sre
    import sre_parse


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str  # what Java and Python read alike; letters in either case where any_case
    any_case: bool = False
    least: int = 0  # characters that the checked group must have
    group: int = 0


#: The base rules, then those that the method adds; the order is that of equal starts in the output.
RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", True, 6, 2),
    Rule("access", r"AKIA[A-Z0-9]+", least=20),
    Rule("hex", r"[0-9a-f]+", least=24),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("hub_token", r"(gh[pousr]_[A-Za-z0-9]{36,}|github_pat_[A-Za-z0-9_]{22,})"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("bearer", r"bearer\x20+[A-Za-z0-9._~+/-]{20,}", True),
    Rule("url_login", r"://[^\x20\x09-\x0D/:@]+:[^\x20\x09-\x0D/:@]{3,}@"),
)

#: A Boolean query: None for "any document", a string for one trigram, ("and" | "or", parts).
Query = None | str | tuple
_WIDE = 16
_PART = 256


def _join(op: str, parts: list[Query]) -> Query:
    if op == "or" and any(p is None for p in parts):
        return None
    flat = list(dict.fromkeys(p for p in parts if p is not None))
    return None if not flat else flat[0] if len(flat) == 1 else (op, tuple(flat))


def _strings(texts: set[str]) -> Query:
    """What a document must hold if it holds one of the texts."""
    return _join("or", [_join("and", [t[i : i + 3] for i in range(len(t) - 2)]) for t in sorted(texts)])


def trigram_query(pattern: str) -> Query:
    """The trigrams, lower case, that any match of the pattern implies, as a Boolean query; None if there are none.

    Literal runs are followed through the parse tree as sets of strings; a set that grows wide, or meets
    an open repetition, turns into a condition and the run starts anew.
    """

    def walk(items) -> tuple[set[str], bool, list[Query]]:
        """(strings that end here, whether they are whole matches, conditions so far)."""
        run: set[str] = {""}
        whole, needs = True, []

        def close() -> None:
            nonlocal run, whole
            needs.append(_strings(run))
            run, whole = {""}, False

        for op, arg in items:
            options: set[str] | None = None
            goes_on = False  # the match may repeat here, so the run ends behind the copies that it must have
            if op is sre.LITERAL:
                options = {chr(arg).lower()}
            elif op is sre.IN and all(k is sre.LITERAL for k, _ in arg):
                options = {chr(v).lower() for _, v in arg}
            elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
                low, high, inner = arg
                if (low, high) == (0, 1):
                    some, all_, more = walk(inner)
                    if all_ and not more:
                        options = {"", *some}
                elif low >= 1:
                    some, all_, more = walk(inner)
                    if all_ and not more:
                        options, goes_on = {s * min(low, 4) for s in some}, True
                    needs += more
            elif op is sre.SUBPATTERN:
                some, all_, more = walk(arg[3])
                needs += more
                options = some if all_ else None
            elif op is sre.BRANCH:
                branches = [walk(b) for b in arg[1]]
                if all(b[1] and not b[2] for b in branches):
                    options = set().union(*(b[0] for b in branches))
                else:
                    needs.append(_join("or", [_join("and", [_strings(b[0]) if b[1] else None, *b[2]]) for b in branches]))
            elif op is sre.AT:
                continue
            if options is None or len(run) * len(options) > _WIDE:
                close()
                if options is not None and len(options) <= _WIDE:
                    run = set(options)
            else:
                run = {a + b for a in run for b in options}
            if goes_on:
                close()
        if not whole:
            needs.append(_strings(run))
            run = {""}
        return run, whole, [n for n in needs if n is not None]

    run, whole, needs = walk(sre_parse.parse(pattern))
    return _join("and", [_strings(run) if whole else None, *needs])


def trigrams(query: Query) -> set[str]:
    if query is None:
        return set()
    return {query} if isinstance(query, str) else set().union(*map(trigrams, query[1]))


def postings(rows: DataFrame, wanted: list[str]) -> DataFrame:
    """The inverted index of the wanted trigrams: (trigram, ROW columns), one row for each document that has it.

    Only trigrams of some rule's query are indexed; a row's folded text is searched for each of them.
    """
    folded = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    hits = F.array_compact(F.array(*[F.when(F.contains(F.col("folded"), F.lit(t)), F.lit(t)) for t in wanted]))
    return rows.select(*ROW, folded.alias("folded")).select(*ROW, F.explode(hits).alias("trigram"))


def _intersected(lists: DataFrame, query: Query) -> DataFrame:
    """(ROW columns) of the documents that a Boolean query of trigrams asks for, from its posting lists (trigram, ROW columns).

    The lists are merged by document: what a document has of the query's trigrams is a set of bits, partially aggregated,
    and the query is evaluated on it.
    """
    own = sorted(trigrams(query))
    words = range(-(-len(own) // 63))
    at = F.element_at(F.map_from_arrays(F.array(*map(F.lit, own)), F.array(*[F.lit(i) for i in range(len(own))])), F.col("trigram"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("at") % 63).cast("int"))
    sets = [F.bit_or(F.when(F.floor(F.col("at") / 63) == w, bit).otherwise(F.lit(0).cast("long"))).alias(f"set{w}") for w in words]
    found = lists.where(F.col("trigram").isin(own)).withColumn("at", at).groupBy(*ROW).agg(*sets)

    def holds(q: Query) -> Column:
        if isinstance(q, str):
            k = own.index(q)
            return F.shiftright(F.col(f"set{k // 63}"), k % 63).bitwiseAND(F.lit(1)) == 1
        out = holds(q[1][0])
        for part in q[1][1:]:
            out = out & holds(part) if q[0] == "and" else out | holds(part)
        return out

    return found.where(holds(query)).select(*ROW)


def candidates(rows: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(ROW columns, rules): for each document the set of rules, as bits, whose query its postings satisfy; only non-empty sets.

    The postings are written once, sorted by trigram within each file, so that a rule reads only the parts with its own lists.
    """
    asked = {r.kind: trigram_query(r.pattern) for r in rules}
    index = cut(postings(rows, sorted(set().union(*map(trigrams, asked.values())))).sortWithinPartitions("trigram"), "postings")
    found = None
    for i, r in enumerate(rules):
        if asked[r.kind] is not None:
            own = _intersected(index, asked[r.kind]).withColumn("bit", F.lit(1 << i))
            found = own if found is None else found.unionByName(own)
    return found.groupBy(*ROW).agg(F.bit_or("bit").alias("__sg_rules"))


def _spans(text: Column, rule: Rule, order: int) -> Column:
    """Leftmost non-overlapping matches as structs (start, order, end), in code points; failing ones dropped.

    The gaps between matches come from a split by the same pattern; starts are sums of gaps and matches. An
    array that a fold appends to is copied each time, so matches are taken _PART at a time, each part from its own start.
    """
    pattern = ("(?i)" if rule.any_case else "") + rule.pattern
    empty = F.array().cast("array<struct<start:int,order:int,end:int>>")
    moved = lambda at, x: at + x["gap"] + F.coalesce(x["n"], F.lit(0))

    def walked(part: Column, at: Column) -> Column:
        def step(acc: Column, x: Column) -> Column:
            begin = acc["at"] + x["gap"]
            here = F.struct(begin.alias("start"), F.lit(order).alias("order"), (begin + x["n"]).alias("end"))
            return F.struct(moved(acc["at"], x).alias("at"), F.when(x["keep"], F.concat(acc["out"], F.array(here))).otherwise(acc["out"]).alias("out"))

        return F.aggregate(part, F.struct(at.alias("at"), empty.alias("out")), step, lambda acc: acc["out"])

    def starts(parts: Column) -> Column:
        totals = F.transform(parts, lambda p: F.aggregate(p, F.lit(0), moved))
        first = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(totals, first, lambda acc, n: F.struct((acc["at"] + n).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")), lambda acc: acc["out"])

    def place(found: Column) -> Column:
        lengths = F.zip_with(F.split(text, pattern, -1), found, lambda g, m: F.struct(F.length(g).alias("gap"), F.length(m["m"]).alias("n"), m["keep"].alias("keep")))
        parted = lambda xs: F.transform(F.sequence(F.lit(1), F.size(xs), F.lit(_PART)), lambda i: F.slice(xs, i, _PART))
        return let(lengths, lambda xs: let(parted(xs), lambda parts: F.flatten(F.zip_with(parts, starts(parts), walked))))

    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    if rule.group:
        checked = F.regexp_extract_all(text, F.lit(pattern), F.lit(rule.group))
        found = F.zip_with(whole, checked, lambda m, g: F.struct(m.alias("m"), (F.length(g) >= rule.least).alias("keep")))
    else:
        found = F.transform(whole, lambda m: F.struct(m.alias("m"), (F.length(m) >= rule.least).alias("keep")))
    return let(found, lambda v: F.when(F.exists(v, lambda x: x["keep"]), place(v)).otherwise(empty))


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, text, and found: array of structs (start, order, end) over all rules by start, then rule.

    A rule whose query demands trigrams runs only on the documents that the index returns for it; a rule
    without mandatory trigrams scans every document. Null texts count as empty; ids may be null or repeat
    (rows are told apart by their place); very long texts are whole; empty in, empty out.
    """
    rows = with_row_id(docs).select(*ROW, F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    hits = cut(candidates(rows, rules), "candidates")
    both = rows.join(hits, ROW, "left")
    empty = F.array().cast("array<struct<start:int,order:int,end:int>>")
    parts = []
    for i, r in enumerate(rules):
        spans = _spans(F.col("text"), r, i)
        if trigram_query(r.pattern) is not None:
            spans = F.when(F.shiftright(F.col("__sg_rules"), i).bitwiseAND(F.lit(1)) == 1, spans).otherwise(empty)
        parts.append(spans)
    return both.select("doc_id", "text", F.array_sort(F.concat(*parts)).alias("found"))


def _written(found: Column, rules: tuple[Rule, ...]) -> Column:
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", F.element_at(kinds, x["order"] + 1), x["start"], x["end"])), ",")


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(read_table(spark, sf_dir, "documents")).select("doc_id", "found")
    count = lambda k: F.size(F.filter("found", lambda x: x["order"] == k)).cast("long")
    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(_written(F.filter("found", lambda x: x["order"] < 3), RULES), 256).alias("base_sha256"), _written(F.col("found"), RULES).alias("spans"),
    )
