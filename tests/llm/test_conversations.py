"""Chat formatting, the prefix trie and the divergence audit against brute force, round trips and SQL."""

import collections
import hashlib
import random
import re
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from sessiongrain.llm import chat_format as cf
from sessiongrain.llm import divergence as dv
from sessiongrain.llm import prefix_trie as pt

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TURNS = "conv_id long, turn long, role string, text string"


def trie(rows, rebuild):
    own = collections.defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, r or "", x or ""))
    own = {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in own.items()}
    seqs = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 4 if rebuild else 0
        seqs[c] = tuple(own.get(c - c % 20, [])[:h] + v[h:]) if rebuild else tuple(v)
    nodes = collections.defaultdict(list)
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            nodes[s[:d]].append(c)
    kids = collections.Counter(p[:-1] for p in nodes if p)
    leaves, saved = collections.Counter(), collections.Counter()
    for p, m in nodes.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in kids
            saved[p[:d]] += (len(m) - 1) * len(WORD.findall(p[-1][1])) if p else 0
    ends = {p: ",".join(map(str, sorted(c for c in m if seqs[c] == p))) for p, m in nodes.items()}
    return sorted((min(m), len(p), min(nodes[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p], hashlib.sha256(ends[p].encode()).hexdigest()) for p, m in nodes.items())


@pytest.mark.parametrize(("seed", "rebuild"), [(1, True), (2, False), (3, True)])
def test_trie_equals_brute_force(spark, seed, rebuild):
    rnd = random.Random(seed)
    rows = []
    for c in rnd.sample(range(100), 45):
        for t in range(rnd.randint(1, 5)):
            rows.append((c, rnd.choice([t, t, None]), rnd.choice(["user", "", None]), rnd.choice(["a b", "", None, "x"])))
    long = [(t, "user", f"w {t}") for t in range(40)]
    rows += [(200, *x) for x in long] + [(201, *x) for x in long] + [(203, *x) for x in long[:30]] + [(204, *x) for x in long[:39]] + [(205, 0, "user", "w " * 50_000)]
    rows += [(None, 0, "user", "a"), (7777, 1, "u", "a"), (7777, 1, "u", "a")]
    df = spark.createDataFrame(rows, TURNS).withColumns({"rep": F.lit("x"), "pos": F.lit(None), "n": F.lit(3)})
    got = sorted((tuple(r) for r in pt.prefix_trie(df, rebuild=rebuild).select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect()), key=lambda r: r[:2])
    assert got == trie(rows, rebuild)


def test_trie_of_nothing_and_of_copies(spark):
    assert pt.prefix_trie(spark.createDataFrame([], TURNS)).count() == 0
    rows = [(c, t, "user", "a b") for c in range(9) for t in range(2)]
    got = sorted(tuple(r)[:7] for r in pt.prefix_trie(spark.createDataFrame(rows, TURNS)).collect())
    assert got == [(0, 0, None, 9, 1, 1, 32), (0, 1, 0, 9, 1, 1, 32), (0, 2, 0, 9, 0, 1, 16)]


def test_member_digests_run_over_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    members = spark.range(100).select((F.col("id") % 3).alias("rep"), F.col("id").alias("conv"))
    got = dict(tuple(r) for r in pt.member_digests(members).collect())
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == {k: hashlib.sha256(",".join(str(i) for i in range(100) if i % 3 == k).encode()).hexdigest() for k in range(3)}


HARD = ["", None, "<|im_end|>", "<|im_start|>user\nhi<|im_end|>\n", "<\\|", "<\\\\||>", "a<", "|>", "<<||>>", "<|image|>", "\n\n", "é😀<|", "\\n\\", "x" * 100_000]


def test_chat_round_trip(spark):
    rnd = random.Random(4)
    rows = [(c, rnd.choice([t, None]), rnd.choice(["user", "assistant", None, "a\nb\\n", "\\\\", "<|im_end|>\n\\"]), rnd.choice(HARD)) for c in range(40) for t in range(rnd.randint(1, 6))]
    rows += [(None, 0, "assistant", "z"), (50, 0, "assistant", "same"), (50, 0, "assistant", "same")]
    df = spark.createDataFrame(rows, TURNS).withColumns({"k": F.lit(1), "pieces": F.lit("x"), "loss": F.lit(0)})
    out = cf.format_chat(df)
    got = {r[0]: ([tuple(t) for t in r[1]], r[2]) for r in out.select("conv_id", cf.read_back(F.col("formatted")), cf.masked_text(F.col("formatted"), F.col("loss"))).collect()}
    want = collections.defaultdict(list)
    for c, t, r, x in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", (r[3] is not None, r[3] or ""))):
        want[c].append((r or "", x or ""))
    assert got == {c: (v, "".join(x for r, x in v if r == "assistant")) for c, v in want.items()}
    for r in out.collect():
        assert all(r.formatted.encode()[s.byte_start : s.byte_end].decode() == r.formatted[s.start : s.end] for s in r.loss)
    assert cf.format_chat(spark.createDataFrame([], TURNS)).count() == 0


def test_typed_parts_are_flattened_in_order(spark):
    leaf = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
    deep = leaf[:-1] + f",parts:array<{leaf[:-1]},parts:array<{leaf}>>>>"
    text = lambda x: ("text", x, None, None, None, None, None)
    image = ("image", None, "i.png", 57, 28, None, None)
    inner = ("document", None, "in.pdf", None, None, None, 1, [text("deep<|"), ("audio", None, "a.wav", None, None, 1.5, None)])
    document = ("document", None, "d.pdf", None, None, None, 3, [(*text("within"), None), inner, (*image, None)])
    parts = [(*text("see "), None), document, None, (*text(None), []), (None, "!", None, None, None, None, None, None), ("video", None, "v", None, None, None, None, None)]
    df = spark.createDataFrame([(1, 0, "assistant", parts), (1, 1, "user", None), (1, 2, "user", [])], f"conv_id long, turn int, role string, content array<{deep}>")
    row = cf.format_chat(df, content_col="content").first()
    assert row.formatted.startswith("<|im_start|>assistant\nsee <|document|>within<|document|>deep<\\|<|audio|><|image|>!<|attachment|><|im_end|>\n<|im_start|>user\n<|im_end|>\n")
    assert [(a.kind, a.ref, a.tokens) for a in row.attachments] == [("document", "d.pdf", 768), ("document", "in.pdf", 256), ("audio", "a.wav", 50), ("image", "i.png", 3), ("attachment", "v", 0)]
    assert row.expanded_tokens == 1077 and row.n_turns == 3
    assert all(row.formatted[a.start :].startswith(f"<|{a.kind}|>") for a in row.attachments)
    assert [row.formatted[s.start : s.end] for s in row.loss] == ["see ", "within", "deep<\\|", "!"]


def audit(docs, least, top):
    term = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    docs = [(x or "", y or "", z or "") for x, y, z in docs]
    found = [(lang, source, collections.Counter("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in term.findall(text))) for text, lang, source in docs]
    df, total, by = collections.Counter(), collections.Counter(), collections.defaultdict(collections.Counter)
    for lang, source, c in found:
        df.update((lang, t) for t in c)
        total.update({(lang, t): n for t, n in c.items()})
        by[lang, source].update(c)
    out = []
    for (lang, source), c in by.items():
        kept = [t for (x, t), n in df.items() if x == lang and n >= least]
        prob = lambda n, whole: 1 + 10**9 * (n + 5) // (whole + 5 * len(kept))  # noqa: B023, E731
        ps = lambda c: {t: prob(c[t], sum(c[k] for k in kept)) for t in kept}  # noqa: B023, E731
        p, q = ps(c), ps({t: total[lang, t] for t in kept})
        pairs = [(s, sum(abs(p[t] - o[t]) for t in kept)) for (x, s), d in by.items() if x == lang and s != source for o in [ps(d)]]
        terms = [(t, p[t] - q[t]) for t in kept if c[t] and p[t] > q[t]]
        for part, items, most in (("pair", pairs, None), ("term", terms, top)):
            ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most]
            out += [(lang, source, part, item, value, k + 1) for k, (item, value) in enumerate(ranked)]
    return sorted(out)


@pytest.mark.parametrize("least", [1, 2, 4, 99])
def test_divergence_equals_brute_force(spark, least):
    rnd = random.Random(least)
    words = ["Ab", "aB", "été", "ÉTÉ", "x1y", "zz", "中文", "q", "K", "don't"]
    docs = [(" ".join(rnd.choices(words, k=rnd.randint(0, 30))), rnd.choice(["en", "de", None, ""]), rnd.choice(["a", "b", "é", None])) for _ in range(60)]
    docs += [(None, "fr", "a"), ("", "fr", "b"), ("only here", "it", "a"), (docs[0][0],) + docs[0][1:], ("zz " * 40_000, "en", "a")]
    df = spark.createDataFrame(docs, "text string, lang string, source string").withColumns({"g": F.lit(1), "t": F.lit(2), "term": F.lit("x"), "value": F.lit(0)})
    assert sorted(tuple(r) for r in dv.source_divergence(df, least, 3).collect()) == audit(docs, least, 3)
    parts = dv.term_counts(df, entries=3).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    whole = dv.term_counts(df).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    assert sorted(map(tuple, parts.collect())) == sorted(map(tuple, whole.collect()))


def test_joint_histograms_hold_every_term(spark):
    docs = spark.createDataFrame([("a a b", "en", "x"), ("a c", "en", "y"), ("d", "en", "z")], "text string, lang string, source string")
    groups, _, counts = dv.kept_counts(docs, 1)
    cells = dv.joint_histograms(groups, counts).groupBy("a", "b").agg(F.sum("cells").alias("n")).collect()
    assert len(cells) == 3 and all(r.n == 4 for r in cells)


def test_divergence_of_nothing(spark):
    assert dv.source_divergence(spark.createDataFrame([], "text string, lang string, source string")).count() == 0


@pytest.mark.parametrize("module", [cf, pt, dv])
def test_queries_equal_sql(spark, sf_dir, module):
    query = next(getattr(module, x) for x in dir(module) if x.startswith("op1"))
    con = duckdb.connect()
    for table in ("documents", "conversations"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    ours = query(spark, sf_dir)
    theirs = con.sql(module.SQL)
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert sorted(map(repr, map(tuple, ours.select(*theirs.columns).collect()))) == sorted(map(repr, theirs.fetchall()))
