"""The pipeline on a small table, each stage against the operator's brute-force reading."""

import re
import zlib

import numpy as np
import pytest

import corpus_pipeline as cp
from sessiongrain.llm import common
from tests.llm.test_near_duplicates import survivors

P = pytest.importorskip("public_tokenizers")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_stages(spark, sf_dir):
    from tokenizers import Tokenizer

    assert [n for n, _ in cp.STAGES] == ["quality_rules", "simhash_near_dedup", "benchmark_decontamination", "source_mixing", "token_binary_output"]
    docs = common.read_table(spark, sf_dir, "documents")
    columns, before = docs.columns, docs.toPandas()
    for name, stage in cp.STAGES[:-1]:
        docs = common.cut(stage(spark, docs, sf_dir), name)
        now = docs.toPandas()
        assert docs.columns == columns
        gone = before[~before.doc_id.isin(now.doc_id)]
        if name == "quality_rules":
            assert 0 < len(gone) < len(before) / 3 and all(len(WORD.findall(t)) >= 10 for t in now.text)
        elif name == "simhash_near_dedup":
            assert sorted(now.doc_id) == sorted(before.doc_id.iloc[k] for k in survivors(list(zip(before.doc_id, before.text, strict=True))))
        elif name == "benchmark_decontamination":
            items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").toPandas()
            flat = lambda t: " ".join(re.findall(r"\w+", t.lower()))
            held = [d for d, t in zip(before.doc_id, before.text, strict=True) if any(flat(i) in flat(t) for i in items.text)]
            assert held and not set(held) & set(now.doc_id) and len(gone) < len(before) / 5
        else:
            size = before.set_index("doc_id").text.map(lambda t: len(WORD.findall(t)))
            taken = now.set_index("doc_id").text.map(lambda t: len(WORD.findall(t)))
            assert (taken <= 2 * size[taken.index]).all() and abs(taken.sum() - 1.5 * size.sum()) <= 10
        before = now
    out = cp.STAGES[-1][1](spark, docs, sf_dir).toPandas().sort_values("start")
    whole, at = Tokenizer.from_file(P.path("word_bpe_49k.json")), 0
    for r, t in zip(out.itertuples(), before.sort_values("doc_id").text, strict=True):
        ids = [*whole.encode(t, add_special_tokens=False).ids, 2]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


ROWS = [(None, "one"), (None, "two"), (None, "three"), (7, "four"), (7, "five"), (8, "six")]


def test_stages_on_odd_tables(spark, tmp_path):
    """Null and repeated ids, null, empty, blank and long texts, clashing columns, an empty table: no stage crashes or loses a clean row."""
    import random

    rnd = random.Random(3)
    prose = lambda n: " ".join("".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(3, 8))) for _ in range(n)) + "."
    rows = [(d, prose(60), "en", "s", 1) for d, _ in ROWS] + [(9, None, None, None, None), (10, "", "en", "s", 0), (None, " \n ", "en", None, 3), (11, prose(30_000), "de", "s", 1), (8, prose(40), None, "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for c in ("root", "node", "item_id", "size", "block", "fp", "grp", "d2", "bucket"):
        docs = docs.withColumn(c, docs["n_chars"])
    docs.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "nothing of this kind is in any of the texts here, not one word")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for empty in (False, True):
        now = common.read_table(spark, str(tmp_path), "documents")
        now = common.cut(now.limit(0), "empty") if empty else now
        for name, stage in cp.STAGES[:-1]:
            now = common.cut(stage(spark, now, str(tmp_path)), name)
            assert now.columns == docs.columns
            if name != "source_mixing":
                assert now.count() == (0 if empty else 8), name
        assert cp.STAGES[-1][1](spark, now, str(tmp_path)).count() == now.count()


def test_reruns_agree(spark, sf_dir, tmp_path):
    """A second run, and one on the table written anew in another order and other files, give equal rows."""
    rows = lambda df: sorted(map(tuple, df.collect()))
    part = common.read_table(spark, sf_dir, "documents").where("n_chars < 2000")
    part.write.parquet(f"{tmp_path}/a/documents.parquet")
    part.orderBy("text").repartition(5).write.parquet(f"{tmp_path}/b/documents.parquet")
    for d in "ab":
        common.read_table(spark, sf_dir, "benchmark").write.parquet(f"{tmp_path}/{d}/benchmark.parquet")
    first = rows(cp.run(spark, f"{tmp_path}/a"))
    assert first and first == rows(cp.run(spark, f"{tmp_path}/b"))
