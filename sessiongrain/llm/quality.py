"""Quality rules: base rules, then robust multivariate outliers by minimum-covariance-determinant estimates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sessiongrain.llm.common import ROW, cut, discard, let, read_table, with_row_id

SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
LEAST_WORDS = 10
MOST_REPEATED = 20  # per cent of the words

#: Share of a group's rows that the estimate rests on: a quarter may be anything.
SUBSET = 0.75
#: Concentration steps of every start; each lowers the determinant, and few remain after the first ones.
STEPS = 3
#: Deterministic starts: no correlation, correlation of the tanh of the scaled statistics, their spatial signs.
STARTS = 3
#: Factors that make the scatter of a truncated normal sample that of the whole: share / P(chi2_6 <= q), with P(chi2_4 <= q) = share.
CONSISTENCY = 1.486  # share SUBSET
CONSISTENCY_WEIGHTED = 1.0645  # share 0.975
#: Rows up to this squared distance, the 0.975 quantile of chi-square in four dimensions, make the reweighted estimate.
WEIGHTED = 11.143
#: A group of n rows has its scatter widened by 1 + SMALL / n and its floor by 1 + (SMALL / n)**2, as estimates from few rows are too narrow.
SMALL = 10.0
#: Steps of the histograms that find medians (a unit of a statistic) and subsets (a doubling of 1 + distance).
FINE = 256
#: Variance added to a statistic, in its transformed unit, so that constant statistics give no singular estimate. Each is small
#: enough that the statistic alone can pass CUTOFF within its range: shares of symbols from 9.4 %, of duplicate lines from 47 %,
#: of repeated words from 18.8 % (the base rule ends at 20 %), where the rest of the group has none.
FLOOR = (4e-3, 4e-3, 2e-2, 8e-3)
#: Squared distance beyond which a row is rejected: the 0.9999 quantile of chi-square in four dimensions.
CUTOFF = 23.513
#: Parts into which the rows of a group are dealt where they meet their group's parameters.
SALTS = 64
STATS = ("v0", "v1", "v2", "v3")
_N = len(STATS)


def _words(text: Column) -> Column:
    """Words of a text as an array; none: empty."""
    return F.filter(F.split(text, SPACES), lambda w: w != "")


def _repeated_words(words: Column) -> Column:
    """Words that lie in windows of WINDOW words found twice or more in the text."""

    def of_hashes(h: Column) -> Column:
        windows = F.transform(F.sequence(F.lit(0), F.size(h) - WINDOW), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)]))

        def of_windows(g: Column) -> Column:
            def of_sorted(s: Column) -> Column:
                twice = F.filter(s, lambda x, k: (F.get(s, k - 1)["g"] == x["g"]) | (F.get(s, k + 1)["g"] == x["g"]))
                at = F.array_sort(F.transform(twice, lambda x: x["i"]))
                return let(at, lambda p: F.aggregate(F.transform(p, lambda v, k: F.least(F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - v, F.lit(WINDOW)))), F.lit(0), lambda a, x: a + x))

            placed = F.sort_array(F.transform(g, lambda x, i: F.struct(x.alias("g"), i.alias("i"))))
            return F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0)).otherwise(let(placed, of_sorted))

        return F.when(F.size(h) < WINDOW, F.lit(0)).otherwise(let(windows, of_windows))

    return let(F.transform(words, lambda w: F.xxhash64(w)), of_hashes)


def base_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs' rows as ROW columns, doc_id, lang, source, and the base counts and verdict of the contract."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    plain = [F.col(c) if c in docs.columns else F.lit(None).cast("string") for c in ("lang", "source")]
    rows = with_row_id(docs).select(*ROW, F.col(id_col).alias("doc_id"), plain[0].alias("lang"), plain[1].alias("source"), text.alias("text"))
    lines = F.filter(F.split("text", "\n"), lambda x: F.length(F.translate(x, " \t\x0b\x0c\r", "")) > 0)
    counts = F.struct(
        F.length(F.translate("text", " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
    )
    of_lines = let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    of_words = let(_words(F.col("text")), lambda w: F.struct(F.size(w).cast("long").alias("n_words"), _repeated_words(w).cast("long").alias("n_repeat_words")))
    out = rows.select(*ROW, "doc_id", "lang", "source", counts.alias("c"), of_lines.alias("l"), of_words.alias("w"))
    out = out.select(*ROW, "doc_id", "lang", "source", "w.n_words", "c.word_chars", "c.n_symbols", "l.n_lines", "l.n_dup_lines", "w.n_repeat_words")
    return out.withColumn("base_failed", (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")))


def vectors(rows: DataFrame) -> DataFrame:
    """The transformed statistics of rows that passed the base rules: shares on a square-root scale (which
    evens their variance), the mean word length on a logarithmic one."""
    n = F.col("n_words").cast("double")
    return rows.select(
        "*",
        F.log(F.col("word_chars") / n).alias("v0"),
        F.sqrt(F.col("n_symbols") / F.col("word_chars").cast("double")).alias("v1"),
        F.sqrt(F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)).cast("double")).alias("v2"),
        F.sqrt(F.col("n_repeat_words") / n).alias("v3"),
    )


_PAIRS = [(i, j) for i in range(_N) for j in range(i + 1)]


def _sums() -> list[Column]:
    """Count, sums and sums of products of the statistics, all partially aggregated."""
    return list(map(F.expr, ["count(*) AS n", *[f"sum(v{i}) AS a{i}" for i in range(_N)], *[f"sum(v{i} * v{j}) AS b{i}{j}" for i, j in _PAIRS]]))


def _moments(sums: DataFrame, keys: list[str], consistency: float) -> DataFrame:
    """Rows of _sums() -> mean vector m* and covariance matrix s* (made consistent, with the floor on its diagonal)."""
    cells = [f"(b{i}{j} / n - a{i} / n * (a{j} / n)) * {consistency}D" + (f" + {FLOOR[i]}D" if i == j else "") + f" AS s{i}{j}" for i, j in _PAIRS]
    return sums.selectExpr(*keys, *[f"a{i} / n AS m{i}" for i in range(_N)], *cells)


def _factor(groups: DataFrame) -> DataFrame:
    """Groups with the Cholesky factor l* of their scatter and its determinant, written as columns: one small row a group."""
    cells = []
    for i, j in _PAIRS:
        rest = " - ".join([f"s{i}{j}", *[f"l{i}{k} * l{j}{k}" for k in range(j)]])
        cells.append((f"sqrt(greatest({rest}, 1e-9D))" if i == j else f"({rest}) / l{j}{j}") + f" AS l{i}{j}")
    return groups.selectExpr("*", *cells, "l00 * l11 * l22 * l33 AS det")


def _distance(rows: DataFrame) -> DataFrame:
    """rows with the squared Mahalanobis distance d2, by forward substitution."""
    z = ["(" + " - ".join([f"v{i} - m{i}", *[f"l{i}{k} * z{k}" for k in range(i)]]) + f") / l{i}{i} AS z{i}" for i in range(_N)]
    return rows.selectExpr("*", *z, " + ".join(f"z{i} * z{i}" for i in range(_N)) + " AS d2")


def _with_group(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """rows with the columns of their group: each group's row is repeated for every salt, so one group's rows spread over tasks."""
    salted = groups.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = rows.withColumn("salt", F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS)).cast("int"))
    return dealt.join(salted, ["grp", "salt"]).drop("salt")


def _quantile_bins(bins: DataFrame, keys: list[str], share: float) -> DataFrame:
    """(keys, bin) rows -> (keys, bin): the least bin up to which `share` of the rows of equal keys lie.

    Rows are counted by bin first (a few thousand bins a key at most), so a key of any size is one small
    histogram, and the answer does not depend on the order in which partial results meet.
    """
    counts = bins.groupBy(*keys, "bin").agg(F.count("*").alias("n"))
    up_to = F.sum("n").over(Window.partitionBy(*keys).orderBy("bin"))
    whole = F.sum("n").over(Window.partitionBy(*keys))
    return counts.select(*keys, "bin", up_to.alias("up_to"), whole.alias("whole")).where(F.col("up_to") >= share * F.col("whole")).groupBy(*keys).agg(F.min("bin").alias("bin"))


def _medians(values: DataFrame) -> DataFrame:
    """(grp, v0..v3) -> (grp, c0..c3): medians, to the width of a bin."""
    long = values.select("grp", F.posexplode(F.array(*STATS)).alias("k", "v")).select("grp", "k", F.floor(F.col("v") * FINE).alias("bin"))
    found = _quantile_bins(long, ["grp", "k"], 0.5)
    return found.groupBy("grp").agg(*[F.max(F.when(F.col("k") == i, (F.col("bin") + 0.5) / FINE)).alias(f"c{i}") for i in range(_N)])


def _starts(rows: DataFrame) -> DataFrame:
    """(grp, v0..v3) -> (grp, start, m*, s*): medians as centres, and the median deviations with three shapes as scatters."""
    middle = cut(_medians(rows), "medians")
    away = _with_group(rows, middle).select("grp", *[F.abs(F.col(v) - F.col(f"c{i}")).alias(v) for i, v in enumerate(STATS)])
    spread = _medians(away).select("grp", *[F.sqrt(F.greatest(F.col(f"c{i}") * F.col(f"c{i}") * 2.198, F.lit(FLOOR[i]))).alias(f"w{i}") for i in range(_N)])
    scale = cut(middle.join(spread, "grp"), "scales")
    z = [(F.col(v) - F.col(f"c{i}")) / F.col(f"w{i}") for i, v in enumerate(STATS)]
    norm = F.sqrt(z[0] * z[0] + z[1] * z[1] + z[2] * z[2] + z[3] * z[3])
    scaled = _with_group(rows, scale).select("grp", *[F.tanh(x).alias(f"t{i}") for i, x in enumerate(z)], *[F.when(norm > 0, x / norm).otherwise(0.0).alias(f"u{i}") for i, x in enumerate(z)])
    shape = scaled.groupBy("grp").agg(*[F.covar_pop(f"t{i}", f"t{j}").alias(f"t{i}{j}") for i, j in _PAIRS], *[F.avg(F.col(f"u{i}") * F.col(f"u{j}")).alias(f"u{i}{j}") for i, j in _PAIRS])
    known = scale.join(shape, "grp")
    width = lambda i, j: F.col(f"w{i}") * F.col(f"w{j}")
    tanh = lambda i, j: F.coalesce(F.try_divide(F.col(f"t{i}{j}"), F.sqrt(F.col(f"t{i}{i}") * F.col(f"t{j}{j}"))), F.lit(0.0))
    cells = {
        0: lambda i, j: width(i, j) if i == j else F.lit(0.0),
        1: lambda i, j: width(i, j) * (F.lit(1.0) if i == j else tanh(i, j)),
        2: lambda i, j: width(i, j) * _N * F.col(f"u{i}{j}") + (F.lit(FLOOR[i]) if i == j else F.lit(0.0)),
    }
    options = [F.struct(F.lit(k).alias("start"), *[F.col(f"c{i}").alias(f"m{i}") for i in range(_N)], *[cells[k](i, j).alias(f"s{i}{j}") for i, j in _PAIRS]) for k in range(STARTS)]
    return known.select("grp", F.explode(F.array(*options)).alias("o")).select("grp", "o.*")


def mcd_estimates(rows: DataFrame) -> DataFrame:
    """(grp, v0..v3) -> one row a group: centre m*, scatter s*, Cholesky factor l*.

    From each start, concentration steps: distances of all rows, the nearest SUBSET of the group (whole histogram
    bins with their sums, so ties are in), their moments as the next estimate. The start with the least determinant wins
    (ties: the first), and the rows within WEIGHTED of it give the final, reweighted estimate. Every group, however small, is
    estimated from its own rows alone. Each step is one aggregation and a join by group; a group of any size is spread over
    tasks, and no matrix leaves the cluster.
    """
    near = F.floor(F.log2(1 + F.col("d2")) * FINE).alias("bin")
    order = Window.partitionBy("grp", "start").orderBy("bin")
    before = F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    whole = F.sum("n").over(Window.partitionBy("grp", "start"))
    estimate = cut(_factor(_starts(rows)), "mcd")
    for _ in range(STEPS):
        bins = _distance(_with_group(rows, estimate)).select("grp", "start", *STATS, near).groupBy("grp", "start", "bin").agg(*_sums())
        inside = bins.select("*", before.alias("before"), whole.alias("whole")).where(F.col("before") < SUBSET * F.col("whole"))
        sums = inside.groupBy("grp", "start").agg(*[F.sum(c).alias(c) for c in bins.columns if c not in ("grp", "start", "bin")])
        following = cut(_factor(_moments(sums, ["grp", "start"], CONSISTENCY)), "mcd")
        discard(estimate)
        estimate = following
    best = estimate.groupBy("grp").agg(F.min_by(F.struct(*[c for c in estimate.columns if c not in ("grp", "start")]), F.struct("det", "start")).alias("b")).select("grp", "b.*")
    weighted = _distance(_with_group(rows, best)).where(F.col("d2") <= WEIGHTED).groupBy("grp").agg(*_sums()).join(rows.groupBy("grp").agg(F.count("*").alias("size")), "grp")
    wide = _moments(weighted, ["grp", "size"], CONSISTENCY_WEIGHTED)
    floor = lambda i, j: FLOOR[i] if i == j else 0.0
    cells = [f"(s{i}{j} - {floor(i, j)}D) * (1 + {SMALL}D / size) + {floor(i, j)}D * (1 + power({SMALL}D / size, 2)) AS s{i}{j}" for i, j in _PAIRS]
    wide = wide.selectExpr("grp", *[f"m{i}" for i in range(_N)], *cells)
    return cut(_factor(wide), "mcd")


def judged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ROW columns, doc_id, base counts, base_failed, d2 (null if base_failed), kept.

    Null and blank texts have no words and fail the base rules. Groups are (lang, source), nulls being values
    of their own; the verdict of a row rests on its own group alone. Where no rows passed
    the base rules there is nothing to estimate and nothing more to reject. Null and repeated ids are carried;
    equal rows get equal verdicts; lang and source may be missing; empty in, empty out.
    """
    stats = cut(base_statistics(docs, id_col, text_col), "statistics")
    grouped = cut(vectors(stats.where(~F.col("base_failed"))).select(*ROW, F.to_json(F.struct("lang", "source")).alias("grp"), *STATS), "vectors")
    estimate = mcd_estimates(grouped.select("grp", *STATS))
    scored = _distance(_with_group(grouped, estimate)).select(*ROW, "d2")
    out = stats.join(scored, ROW, "left")
    return out.withColumn("kept", ~F.col("base_failed") & (F.coalesce("d2", F.lit(0.0)) <= CUTOFF))


def drop_low_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without the rows that are rejected. Columns unchanged.

    Null, empty and blank texts go (no words). Rows are told apart by their place, so null and repeated ids only ride along and equal
    rows stay or go together; columns that bear names of the statistics are kept as they are; empty in, empty out.
    """
    kept = judged(docs, id_col, text_col).where("kept").select(*ROW)
    return with_row_id(docs).join(kept, ROW, "left_semi").select(*docs.columns)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = judged(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.round("d2", 6).alias("d2"))
