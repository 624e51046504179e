"""Scalar expressions over Columns: redaction, masking, identifiers, labels, previews, paths, rates."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Redaction patterns in the order in which they apply; later ones see earlier replacements.
# (?U) makes \w, \d and \b follow Unicode.
REDACTIONS = (
    (r"(?is)-----BEGIN(?: [A-Z0-9]+)? PRIVATE KEY-----.*?-----END(?: [A-Z0-9]+)? PRIVATE KEY-----", "<PRIVATE_KEY>"),
    (r"(?U)(?<![A-Za-z0-9_])sk-[A-Za-z0-9_-]{12,}\b", "<API_KEY>"),
    (r"(?iU)\bBearer\s+[A-Za-z0-9._~+/=-]{12,}", "Bearer <TOKEN>"),
    (
        r"(?iU)(?<label>密码|口令|password|passwd|pwd|passphrase|api[ _-]?key|access[ _-]?token|secret(?:[ _-]?key)?)"
        r"(?<separator>\s*(?::|：|=|是)?\s*)(?<secret>(?!<)[A-Za-z0-9_./+@=-]{6,})",
        r"${label}${separator}<SECRET>",
    ),
    (r"(?U)\b[\w.+-]{1,64}@[\w.-]{1,253}\.[A-Za-z]{2,63}\b", "<EMAIL>"),
    (r"(?U)(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?![\w.])", "<IP_ADDRESS>"),
    (r"""(?U)(?<![\w])/(?:Users|home)/[^\s"']+""", "<LOCAL_PATH>"),
    (r"""(?U)(?<![\w])/mnt/(?:agent-workspace|data)(?:/[^\s"']*)?""", "<LOCAL_PATH>"),
    (r"""(?iU)\b[A-Za-z]:\\Users\\[^\s"']+""", "<LOCAL_PATH>"),
)
# Masks of published text, in order.
PUBLIC_MASKS = (
    (r"(?i)https?://[^\s]+", "[链接]"),
    (r"(?i)\b[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}\b", "[邮箱]"),
    (r"(?i)\b(?:sk|api)[-_][A-Za-z0-9_-]{16,}\b", "[凭据]"),
    (r"(?U)(?<![\w.])/(?:[^\s/]+/)+[^\s,;，。；：:]+", "[本地路径]"),
)
TOKEN_MASK = (r"(?:hf_|ghp_|sk-)[A-Za-z0-9_-]{8,}", "<TOKEN>")


def replace_all(text: Column, rules: Iterable[tuple[str, str]]) -> Column:
    for pattern, put in rules:
        text = F.regexp_replace(text, pattern, put)
    return text


def redact(text: Column) -> Column:
    return replace_all(text, REDACTIONS)


def redact_tokens(text: Column) -> Column:
    return F.regexp_replace(text, *TOKEN_MASK)


def truncate(text: Column, limit: int) -> Column:
    """At most `limit` characters; a cut text ends in an ellipsis."""
    return F.when(F.length(text) > limit, F.concat(F.rtrim(F.left(text, F.lit(limit - 1))), F.lit("…"))).otherwise(text)


def public_text(text: Column, limit: int = 800) -> Column:
    return truncate(replace_all(F.trim(F.coalesce(text, F.lit(""))), PUBLIC_MASKS), limit)


def short_text(text: Column, limit: int = 150) -> Column:
    """White space collapsed, then cut."""
    return truncate(F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " ")), limit)


def digest_id(prefix: str, *parts: Column, length: int = 24, separator: str = "|") -> Column:
    """prefix_ and the first hex digits of SHA-256 over the parts with a separator; null parts are empty."""
    joined = F.concat_ws(separator, *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.concat(F.lit(f"{prefix}_"), F.left(F.sha2(joined, 256), F.lit(length)))


def case_id(batch: Column, trace: Column, episode: Column) -> Column:
    return digest_id("case", batch, trace, episode)


def content_hash(*parts: Column) -> Column:
    """SHA-256 of the parts as JSON in the order given; equal for equal values and types."""
    return F.sha2(F.to_json(F.struct(*parts)), 256)


def label_key(text: Column) -> Column:
    """Labels compare without case and with runs of white space as one space."""
    return F.lower(F.regexp_replace(F.trim(text), r"\s+", " "))


def squeezed(text: Column) -> Column:
    return F.regexp_replace(text, r"\s+", "")


def preview(text: Column, width: int = 180) -> Column:
    whole = F.length(text) <= 2 * width
    none = F.lit(None).cast("string")
    return F.struct(
        F.when(whole, text).alias("text"),
        F.when(whole, none).otherwise(F.left(text, F.lit(width))).alias("head"),
        F.when(whole, none).otherwise(F.right(text, F.lit(width))).alias("tail"),
    )


def rate(part: Column, whole: Column, digits: int = 4) -> Column:
    """part / whole rounded half to even, null where the whole is zero."""
    return F.bround(part / F.nullif(whole.cast("double"), F.lit(0.0)), digits)


def jaccard(both: Column, left: Column, right: Column) -> Column:
    return both / F.nullif((left + right - both).cast("double"), F.lit(0.0))


def lift(both: Column, left: Column, right: Column, total: Column) -> Column:
    return both * total / F.nullif((left * right).cast("double"), F.lit(0.0))


def one_of(value: Column, allowed: Iterable[str], default: str) -> Column:
    return F.when(value.isin(*allowed), value).otherwise(F.lit(default))


def lookup(value: Column, table: Mapping[str, str], default: Column | None = None) -> Column:
    items = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    return F.coalesce(F.try_element_at(items, value), default if default is not None else F.lit(None).cast("string"))


def display(values: Column, table: Mapping[str, str]) -> Column:
    return F.transform(values, lambda v: lookup(v, table, v))


def clean_labels(values: Column) -> Column:
    """Sorted distinct labels without nulls, blanks and 'unknown'."""
    return F.array_sort(F.array_distinct(F.filter(values, lambda v: v.isNotNull() & (F.trim(v) != "") & (v != "unknown"))))


def dotted_path(path: Column) -> Column:
    """JSON pointers and [i] indexes as a dotted path."""
    out = F.regexp_replace(path, r"\[(\d+)\]", ".$1")
    out = F.regexp_replace(out, "/", ".")
    return F.regexp_replace(F.regexp_replace(out, r"\.{2,}", "."), r"^[$.]+", "")


def field_value(document: Column, path: Column) -> Column:
    """The text at a dotted path of a variant; null where there is nothing."""
    keys = F.regexp_replace(F.regexp_replace(path, r"\.(\d+)(?=\.|$)", "[$1]"), r"^(\d+)(?=\.|$)", "[$1]")
    return F.try_variant_get(document, F.concat(F.lit("$."), keys), "string")


def parse_candidates(text: Column) -> Column:
    """The first reading of a model's answer that is JSON: as it is, without fences, from the first brace, with closers added."""
    bare = F.regexp_replace(F.trim(text), r"(?s)^```(?:json)?\s*|\s*```$", "")
    from_brace = F.regexp_extract(bare, r"(?s)(\{.*\})", 1)
    open_brace = F.regexp_extract(bare, r"(?s)(\{.*)", 1)
    tries = F.array(text, bare, from_brace, F.concat(open_brace, F.lit("}")), F.concat(open_brace, F.lit("]}")))
    good = F.filter(tries, lambda t: (F.length(t) > 0) & F.try_parse_json(t).isNotNull())
    return F.try_parse_json(F.get(good, F.lit(0)))


def semantic_anchors(quote: Column, most: int = 5) -> Column:
    """Strings worth searching for: assignments, error names, long tokens; in order, distinct, at most `most`."""
    found = [F.regexp_extract_all(quote, F.lit(p), F.lit(0)) for p in (r"[A-Z][A-Z0-9_]{2,}\s*=\s*[^\s\\]+", r"[A-Za-z_][A-Za-z0-9_.]*(?:Error|Exception)", r"[A-Za-z0-9_./-]{12,}")]
    return F.slice(F.array_distinct(F.concat(*found)), 1, most)


def chunk_id(event_id: Column, offset: Column, size: int = 12_000) -> Column:
    return F.format_string("%s#chunk_%04d", event_id, F.floor(offset / size).cast("int"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once a row however often body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)
