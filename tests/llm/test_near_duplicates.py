import random

import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from sessiongrain.llm import near_duplicates as nd
from sessiongrain.llm.components import connected_components


def brute_print(text, n=3):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + n]) for i in range(len(words) - n + 1)] if len(words) >= n else [b" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def components(prints):
    """Classes of fingerprints at two or fewer bits, by comparing all pairs."""
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def test_vectorised_hash_equals_library():
    rnd = random.Random(1)
    for _ in range(20):
        parts = [bytes(rnd.randrange(256) for _ in range(rnd.choice([0, 1, 3, 4, 7, 8, 15, 31, 32, 33, 63, 64, 100, 129]))) for _ in range(40)]
        buf = __import__("numpy").frombuffer(b"".join(parts), "u1")
        ends = __import__("numpy").cumsum([len(p) for p in parts])
        starts = ends - [len(p) for p in parts]
        assert nd.xxh64(buf, starts, ends, 42).tolist() == [xxhash.xxh64_intdigest(p, 42) for p in parts]


def test_fingerprints_equal_brute_force():
    rnd = random.Random(2)
    texts = ["", None, " \n", "a", "A b", "É a É", "x y z", "X\ty\x0bz"] + [" ".join(rnd.choice(["aa", "Bb", "ß", "c" * 40]) for _ in range(rnd.randint(1, 400))) for _ in range(30)]
    got = nd.simhash(*nd.text_buffers(pa.array(texts)), chunk=50).tolist()
    assert got == [brute_print(t) for t in texts]


@pytest.mark.parametrize("cell", [nd.PAIR_CELL, 2])
def test_links_find_every_class(spark, monkeypatch, cell):
    """Both ways through a cell (pairs, and shared neighbours for larger ones) keep all classes."""
    monkeypatch.setattr(nd, "PAIR_CELL", cell)
    rnd = random.Random(3)
    prints = [rnd.getrandbits(64) for _ in range(15)]
    for _ in range(150):
        x = rnd.choice(prints)
        for _ in range(rnd.randint(1, 3)):
            x ^= 1 << rnd.randrange(64)
        prints.append(x)
    prints = sorted(set(prints))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    edges = nd.linked(spark.createDataFrame([(s,) for s in signed], "fp long"))
    roots = {r["node"]: r["root"] for r in connected_components(edges).collect()}
    want = components(prints)
    got = [roots.get(s, s) for s in signed]
    assert len(set(zip(want, got, strict=True))) == len(set(want)) == len(set(got))


def test_pivot_key_is_the_block_distance():
    spark_free = nd.references()
    assert len(set(spark_free)) == nd.N_REFERENCES and nd.references(3) == spark_free[:3]
    for x in (0, 5, (1 << 64) - 1):
        for block in nd.BLOCKS:
            for r in spark_free:
                inside = ((x ^ r) & nd._mask(block)).bit_count()
                assert (x ^ r).bit_count() - (x ^ r ^ nd._mask(block)).bit_count() + block[1] == 2 * inside


def test_edge_cases_and_drop(spark):
    rows = [(3, "one two three four"), (1, "one two three four"), (None, "one two three four"), (7, None), (8, ""), (9, "  "), (5, "quite another text here"), (5, "quite another text here")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit("clash")).withColumn("root", F.lit(1))
    out = {(r["doc_id"], r["component_id"]) for r in nd.near_duplicates(df).collect()}
    assert out == {(3, 1), (1, 1), (None, 1), (7, 7), (8, 7), (9, 7), (5, 5)}
    kept = nd.drop_near_duplicates(df)
    assert kept.columns == df.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 5, 7]
    assert nd.near_duplicates(df.limit(0)).count() == 0


def test_components_of_paths_and_rings(spark):
    rnd = random.Random(4)
    path = [(i, i + 1) for i in range(60)]
    ring = [(100 + i, 100 + (i + 1) % 17) for i in range(17)]
    edges = path + ring + [(200, 200), (300, 301), (301, 300)]
    rnd.shuffle(edges)
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert len({got[i] for i in range(61)}) == 1 and len({got[100 + i] for i in range(17)}) == 1 and got[300] == got[301] and 200 not in got
    assert len({got[0], got[100], got[300]}) == 3


def shingle_set(text, n=5):
    words = (text or "").encode().lower().split()
    return {b" ".join(words[i : i + n]) for i in range(max(len(words) - n + 1, 1))} if words else set()


def survivors(rows):
    """Indexes of rows left: (doc_id, nulls last; row) of each class of Jaccard 0.8 or more, by comparing all pairs."""
    sets, root = [shingle_set(t) for _, t in rows], list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]) and sets[i] | sets[j] or sets[i] == sets[j]:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    best = {}
    for i, (d, _) in enumerate(rows):
        key = (d is None, d or 0, i)
        best[find(i)] = min(best.get(find(i), key), key)
    return sorted(k[2] for k in best.values())


@pytest.mark.parametrize("cell", [nd.PAIR_CELL, 2])
def test_near_copies_with_edits_go(spark, monkeypatch, cell):
    """Copies with a few edits differ in far more than two bits; both ways through a cell find them."""
    monkeypatch.setattr(nd, "PAIR_CELL", cell)
    rnd = random.Random(8)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(5))
    base = [[word() for _ in range(150)] for _ in range(6)]
    rows = []
    for i in range(60):
        words = list(base[i % 6])
        for _ in range(rnd.randint(0, 2)):
            words[rnd.randrange(150)] = word()
        rows.append((i, " ".join(words)))
    kept = nd.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1))
    got = sorted(r["doc_id"] for r in kept.collect())
    assert got == sorted(rows[k][0] for k in survivors(rows)) and len(got) < 20


def test_rows_not_ids_are_dropped(spark):
    """Several null ids and one id with two different texts: each different text keeps a row."""
    texts = ["alpha beta gamma delta epsilon zeta", "one two three four five six seven", "red green blue cyan pink grey", "north south east west up down left"]
    rows = [(None, texts[0]), (None, texts[1]), (None, texts[1]), (4, texts[2]), (4, texts[3]), (9, texts[3]), (2, texts[1])]
    kept = nd.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1))
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted([(None, texts[0]), (2, texts[1]), (4, texts[2]), (4, texts[3])], key=repr)


def test_crowded_cells_lose_no_link(spark):
    """400 near copies of one text, with as many edits as leave many of them just outside the others' reach: classes as by all pairs."""
    rnd = random.Random(21)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(5))
    base = [word() for _ in range(150)]
    rows = []
    for i in range(400):
        words = list(base)
        for _ in range(rnd.randint(0, 9)):
            words[rnd.randrange(150)] = word()
        rows.append((i, " ".join(words)))
    want = survivors(rows)
    kept = nd.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1))
    assert sorted(r["doc_id"] for r in kept.collect()) == want and 20 < len(want) < 380
