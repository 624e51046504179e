"""Deterministic decisions: routes, judgments, gates, selection criteria, review triage. Null means undecided throughout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def compact(*codes: Column) -> Column:
    return F.array_compact(F.array(*codes))


def episode_route(domain: Column, value: Column, boundary: Column, query: Column, clarity: Column, goal: Column, signals: Column) -> Column:
    """skip for out of scope, low value or neither query nor goal; analyze where all seven conditions hold; else review."""
    skip = (domain == "out_of_scope") | (value == "low") | ((query == "not_identifiable") & (goal == "insufficient"))
    ready = (
        domain.isin("in_scope", "adjacent") & value.isin("high", "medium") & (boundary == "reliable") & (query == "identified")
        & (clarity == "clear") & goal.isin("complete", "partial") & (signals == "present")
    )
    return F.when(skip, "skip").when(ready, "analyze").otherwise("review")


def case_judgment(related: Column) -> Column:
    return F.when(related, "confirmed").when(~related, "excluded").otherwise("review")


def reason_codes(related: Column, warnings: Column) -> Column:
    """Why a case has its judgment; an undecided one lists what is missing, in order."""
    any_of = lambda f: F.exists(warnings, f)
    open_ = compact(
        F.when(any_of(lambda w: F.contains(w, F.lit("unsupported_agent_attribution"))), "unsupported_agent_attribution"),
        F.when(any_of(lambda w: F.contains(w, F.lit("quote_not_exact"))), "evidence_quote_not_exact"),
        F.when(any_of(lambda w: w.endswith(":missing") | w.endswith(":incomplete")), "required_analysis_fields_missing"),
        F.when(any_of(lambda w: F.contains(w, F.lit("evidence_review_insufficient"))), "evidence_review_insufficient"),
        F.when(any_of(lambda w: F.contains(w, F.lit("agent_failure_not_determined"))), "agent_failure_not_determined"),
    )
    return F.when(related, F.array(F.lit("validated_agent_attribution"))).when(~related, F.array(F.lit("validated_non_agent_attribution"))).otherwise(F.when(F.size(open_) > 0, open_).otherwise(F.array(F.lit("agent_attribution_unresolved"))))


def downgrade_attribution(related: Column, failure: Column, reason: Column, gaps: Column, evidence_review: Column | None = None) -> Column:
    """A positive verdict needs a failure, a reason and a gap; an evidence review other than sufficient undoes any verdict."""
    blank = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    out = F.when(related & (blank(failure) | blank(reason) | (F.size(gaps) < 1)), F.lit(None).cast("boolean")).otherwise(related)
    return out if evidence_review is None else F.when(F.coalesce(evidence_review, F.lit("unknown")) == "sufficient", out)


def quality_gates(gates: list[Column], integrity: Column) -> Column:
    """all true and complete: high; any false or broken: low; any null or integrity unknown: unknown; else medium."""
    all_true, any_false, any_null = F.lit(True), F.lit(False), F.lit(False)
    for g in gates:
        all_true, any_false, any_null = all_true & F.coalesce(g, F.lit(False)), any_false | F.coalesce(~g, F.lit(False)), any_null | g.isNull()
    state = F.coalesce(integrity, F.lit("unknown"))
    return F.when(all_true & (state == "complete"), "high").when(any_false | (state == "broken"), "low").when(any_null | (state == "unknown"), "unknown").otherwise("medium")


def claim_support(label_status: Column, statuses: Column, states: Column) -> Column:
    """A claim's status: the label's without reviews; the reviews' where they agree and all are accepted; else unknown."""
    agreed = (F.size(F.array_distinct(statuses)) == 1) & F.forall(states, lambda s: s == "accepted")
    return F.when(F.size(statuses) <= 0, label_status).when(agreed, F.get(statuses, F.lit(0))).otherwise("unknown")


def usable(in_scope: Column, status: Column, conflicts: Column, evidence: Column) -> Column:
    return in_scope & (status == "supported") & (conflicts == 0) & (evidence > 0)


def rule_s1(mapping_parent: Column, primary: Column, mapping_status: Column, claims_usable: Column) -> Column:
    """Per mapping: pass where a primary parent has a supported mapping with usable claims; aggregate with bool_or."""
    return F.coalesce(primary & mapping_parent.isNotNull() & (mapping_status == "supported") & claims_usable, F.lit(False))


def rule_s2(mode: Column, difficulty: Column, any_usable: Column, all_reviewed: Column) -> Column:
    return (
        F.when(mode != "episode", "pending").when(any_usable & difficulty.isin("medium", "high", "2", "3"), "pass")
        .when(difficulty.isin("low", "0", "1") & all_reviewed, "fail").otherwise("pending")
    )


def selection_decision(valid: Column, scope: Column, conflicts: Column, rules: list[Column]) -> Column:
    """invalid: review; a scope or rule failure: not_selected; all passed: priority_candidate; else review.

    While conflicts are open, a rule's failure counts as pending.
    """
    settled = [F.when(conflicts & (r == "fail"), "pending").otherwise(r) for r in rules]
    failed, passed = scope == "fail", scope == "pass"
    for r in settled:
        failed, passed = failed | (r == "fail"), passed & (r == "pass")
    return F.when(~valid, "review").when(failed, "not_selected").when(passed & ~conflicts, "priority_candidate").otherwise("review")


def scope_state(filters: dict[str, list[str]], values: dict[str, Column]) -> Column:
    """AND over dimensions, OR within one; an empty filter restricts nothing; an unknown value is pending."""
    out = F.lit("pass")
    for name, allowed in filters.items():
        if allowed:
            v = values[name]
            one = F.when(v.isNull() | (v == "unknown"), "pending").when(v.isin(*allowed), "pass").otherwise("fail")
            out = F.when((out == "fail") | (one == "fail"), "fail").when((out == "pending") | (one == "pending"), "pending").otherwise("pass")
    return out


def supported_mapping(status: Column, parent: Column, taxonomy_parent: Column, claims: Column, claims_ok: Column, path_ok: Column) -> Column:
    return (status == "supported") & taxonomy_parent.isNotNull() & (parent == taxonomy_parent) & (F.size(claims) > 0) & claims_ok & path_ok


def taxonomy_links(mappings: DataFrame, taxonomy: DataFrame, parent: str = "parent", child: str = "child") -> tuple[DataFrame, DataFrame]:
    """(mappings found in the taxonomy, distinct; mappings that are not). Names match exactly, else without white space where that is unique."""
    from sessiongrain.functions.scalars import squeezed

    t = taxonomy.select(F.col(parent).alias("__p"), F.col(child).alias("__c"), squeezed(F.col(parent)).alias("__sp"), squeezed(F.col(child)).alias("__sc"))
    t = t.withColumn("__same", F.count("*").over(Window.partitionBy("__sp", "__sc")))
    m = mappings.withColumn("__mp", squeezed(F.col(parent))).withColumn("__mc", squeezed(F.col(child)))
    hit = m.join(t, (m["__mp"] == t["__sp"]) & (m["__mc"] == t["__sc"]), "left").where(F.col("__p").isNull() | (F.col("__same") == 1) | ((F.col(parent) == F.col("__p")) & (F.col(child) == F.col("__c"))))
    good = hit.where(F.col("__p").isNotNull()).withColumn(parent, F.col("__p")).withColumn(child, F.col("__c")).select(*mappings.columns).distinct()
    return good, hit.where(F.col("__p").isNull()).select(*mappings.columns)


# Words in a reviewer's note that name an issue.
INTERRUPTED = ("打断", "中断", "截断", "interrupted")
UNRESOLVED = ("为什么要打成需复核", "门槛", "证据不足")
PRESENTATION = ("证据turn", "证据 turn", "找不到", "佐证")


def issue_codes(note: Column, unsupported: Column, unresolved: Column) -> Column:
    has = lambda words: F.exists(F.array(*map(F.lit, words)), lambda w: F.contains(note, w))
    codes = compact(
        F.when(has(INTERRUPTED), "user_interruption_unmodeled"),
        F.when(unsupported, "unsupported_attribution_evidence"),
        F.when(unresolved | has(UNRESOLVED), "unresolved_agent_verification"),
        F.when(has(PRESENTATION), "evidence_presentation_check"),
    )
    return F.when(F.size(codes) > 0, codes).otherwise(F.array(F.lit("manual_triage_required")))


def queue_mode(codes: Column) -> Column:
    rerun = F.exists(codes, lambda c: ~c.isin("evidence_presentation_check", "manual_triage_required"))
    return F.when(rerun, "agent_verify_only").when(F.array_contains(codes, "evidence_presentation_check"), "republish_only").otherwise("manual_triage")


def queue_priority(codes: Column, seed: Column) -> Column:
    return F.when(seed | F.array_contains(codes, "unsupported_attribution_evidence"), "high").otherwise("medium")


def benchmark_note(judgment: Column, clarity: Column, value: Column) -> Column:
    return (
        F.when(judgment == "excluded", "not_recommended").when(judgment == "review", "review_first")
        .when((clarity == "clear") & value.isin("high", "medium"), "recommended").otherwise("needs_detail")
    )


def statistical_advice(hits: Column, q: Column, upper: Column, within_upper: Column, unsupported: Column, protected: Column) -> Column:
    """strict rarity needs q <= 0.05 and an upper bound under 1 %; deletion also zero hits, a parent bound under 5 %, no loose pointers."""
    rare = (q <= 0.05) & (upper < 0.01)
    return F.when(protected, "protected").when(rare & (hits == 0) & (within_upper < 0.05) & (unsupported == 0), "deletion_candidate").when(rare, "strict_rare").otherwise("keep")
