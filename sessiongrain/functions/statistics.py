"""Exact tests and intervals over counts."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


#: Steps upwards before the asymptotic series of the gamma function and of harmonic numbers are used.
SHIFT = 8


def log_factorial(n: Column) -> Column:
    """ln n! of counts from 0 on, by Stirling's series behind SHIFT steps; absolute error below 1e-11 for counts up to 10^4."""
    n = n.cast("double")
    z = n + (SHIFT + 1)
    series = (z - 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi) + 1 / (12 * z) - 1 / (360 * F.pow(z, F.lit(3))) + 1 / (1260 * F.pow(z, F.lit(5))) - 1 / (1680 * F.pow(z, F.lit(7)))
    for i in range(1, SHIFT + 1):
        series = series - F.log(n + i)
    return series


def harmonic(m: Column) -> Column:
    """1 + 1/2 + ... + 1/m, by the asymptotic series behind SHIFT steps."""
    m = m.cast("double")
    z = m + SHIFT
    series = F.log(z) + float(np.euler_gamma) + 1 / (2 * z) - 1 / (12 * z * z) + 1 / (120 * F.pow(z, F.lit(4))) - 1 / (252 * F.pow(z, F.lit(6))) + 1 / (240 * F.pow(z, F.lit(8)))
    for i in range(1, SHIFT + 1):
        series = series - 1 / (m + i)
    return series


def binomial_cdf(rows: DataFrame, k: str, n: str, p: float, into: str = "cdf") -> DataFrame:
    """P[Bin(n, p) <= k] as I(1 - p; n - k, k + 1), the incomplete beta function's continued fraction.

    Work is in the order of sqrt(n) a row, in columns alone. Null counts give null, k < 0 gives 0, k >= n gives 1.
    """
    at, of = F.col(k).cast("long"), F.col(n).cast("long")
    inside = (at >= 0) & (at < of)
    a, b = F.when(inside, of - at).otherwise(1).cast("double"), F.when(inside, at + 1).otherwise(1).cast("double")
    x = 1 - p
    # The fraction is short on one side of the mean; the other side is 1 minus its mirror image.
    direct = F.lit(x) < (a + 1) / (a + b + 2)
    sides = rows.withColumns({"__d": direct, "__a": F.when(direct, a).otherwise(b), "__b": F.when(direct, b).otherwise(a), "__x": F.when(direct, F.lit(x)).otherwise(F.lit(p))})
    ca, cb, cx = F.col("__a"), F.col("__b"), F.col("__x")
    even = lambda m: m * (cb - m) * cx / ((ca - 1 + 2 * m) * (ca + 2 * m))
    odd = lambda m: -(ca + m) * (ca + cb + m) * cx / ((ca + 2 * m) * (ca + 1 + 2 * m))
    rounds = (30 + 5 * F.sqrt(F.greatest(ca, cb))).cast("int")
    terms = F.flatten(F.transform(F.sequence(F.lit(1), rounds), lambda m: F.array(even(m.cast("double")), odd(m.cast("double")))))
    first = 1 / (1 - (ca + cb) * cx / (ca + 1))
    start = F.struct(F.lit(1.0).alias("c"), first.alias("d"), first.alias("h"))

    def step(s: Column, t: Column) -> Column:
        c, d = 1 + t / s["c"], 1 / (1 + t * s["d"])
        return F.struct(c.alias("c"), d.alias("d"), (s["h"] * c * d).alias("h"))

    front = F.exp(log_factorial(ca + cb - 1) - log_factorial(ca - 1) - log_factorial(cb - 1) + ca * F.log(cx) + cb * F.log1p(-cx))
    part = front * F.aggregate(terms, start, step, lambda s: s["h"]) / ca
    value = F.when(at < 0, F.lit(0.0)).when(at >= of, F.lit(1.0)).when(at.isNotNull() & of.isNotNull(), F.least(F.lit(1.0), F.when(F.col("__d"), part).otherwise(1 - part)))
    return sides.withColumn(into, value).drop("__d", "__a", "__b", "__x")


def fisher_greater(rows: DataFrame, both: str, left: str, right: str, total: str, into: str = "p") -> DataFrame:
    """One-sided exact test of a 2 x 2 table: P[X >= both] for a hypergeometric X with margins left and right.

    One term comes from log-factorials: the mode's, or that of `both` behind it. The others follow from it by ratios of
    counts of at most 1, in both directions, so sums on either side of the mean neither overflow nor vanish.
    """
    n, a, b = (F.col(c).cast("long") for c in (total, left, right))
    low, most = F.greatest(F.col(both).cast("long"), a + b - n, F.lit(0).cast("long")), F.least(a, b)
    mode = F.floor((a + 1).cast("double") * (b + 1) / (n + 2))
    bounded = rows.withColumns({"__low": F.least(low, most), "__none": low > most, "__at": F.greatest(F.least(low, most), F.least(mode, most))})
    i, lf = F.col("__at"), log_factorial
    term = F.exp(lf(a) - lf(i) - lf(a - i) + lf(n - a) - lf(b - i) - lf(n - a - b + i) - lf(n) + lf(b) + lf(n - b))
    start = F.struct(F.lit(1.0).alias("t"), F.lit(0.0).alias("s"))
    ratio = lambda j: (a - j + 1).cast("double") * (b - j + 1) / (j.cast("double") * (n - a - b + j))
    none = F.array().cast("array<bigint>")

    def summed(places: Column, factor) -> Column:
        def step(s: Column, j: Column) -> Column:
            t = s["t"] * factor(j)
            return F.struct(t.alias("t"), (s["s"] + t).alias("s"))

        return F.aggregate(places, start, step, lambda s: s["s"])

    up = summed(F.when(i < most, F.sequence(i + 1, most)).otherwise(none), ratio)
    down = summed(F.when(i > F.col("__low"), F.sequence(i, F.col("__low") + 1, F.lit(-1).cast("long"))).otherwise(none), lambda j: 1 / ratio(j))
    value = F.when(F.col("__none"), F.lit(0.0)).otherwise(F.least(F.lit(1.0), term * (1 + up + down)))
    return bounded.withColumn(into, value).drop("__low", "__none", "__at")


def by_adjust(rows: DataFrame, p: str, into: str = "q") -> DataFrame:
    """Benjamini-Yekutieli adjusted p-values: least of p * m * H(m) / rank from the right, at most 1.

    Equal p-values share the greatest of their ranks, so counts of distinct values are enough. They lie in buckets
    of ln p, at most some 200,000 for all doubles: ranks and minima are made within buckets and over whole ones.
    Null p-values are no tests and stay null.
    """
    ln = F.when(F.col("__p") > 0, F.floor(F.log(F.col("__p")) * 256)).otherwise(-1 << 20)
    values = rows.where(F.col(p).isNotNull()).groupBy(F.col(p).alias("__p")).agg(F.count("*").alias("__n")).withColumn("__bucket", ln)
    buckets = values.groupBy("__bucket").agg(F.sum("__n").alias("__n"))
    earlier = F.coalesce(F.sum("__n").over(Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = buckets.select("__bucket", earlier.alias("__offset"), F.sum("__n").over(Window.partitionBy()).alias("__m"))
    inside = F.sum("__n").over(Window.partitionBy("__bucket").orderBy("__p").rowsBetween(Window.unboundedPreceding, 0))
    ranked = values.withColumn("__inside", inside).join(offsets, "__bucket")
    raw = ranked.withColumn("__raw", F.least(F.lit(1.0), F.col("__p") * F.col("__m") * harmonic(F.col("__m")) / (F.col("__offset") + F.col("__inside"))))
    after = F.min("__raw").over(Window.orderBy("__bucket").rowsBetween(1, Window.unboundedFollowing))
    beyond = raw.groupBy("__bucket").agg(F.min("__raw").alias("__raw")).select("__bucket", after.alias("__after"))
    own = F.min("__raw").over(Window.partitionBy("__bucket").orderBy("__p").rowsBetween(0, Window.unboundedFollowing))
    found = raw.withColumn("__own", own).join(beyond, "__bucket").select("__p", F.least("__own", "__after").alias(into))
    return rows.join(found, rows[p] == found["__p"], "left").drop("__p")


def _log_gamma(x: np.ndarray) -> np.ndarray:
    z = x + SHIFT
    series = (z - 0.5) * np.log(z) - z + 0.5 * math.log(2 * math.pi) + 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5) - 1 / (1680 * z**7)
    return series - sum(np.log(x + i) for i in range(SHIFT))


def beta_cdf(x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """I(x; a, b) for 0 < x < 1, for all elements at once."""
    direct = x < (a + 1) / (a + b + 2)
    y, a, b = np.where(direct, x, 1 - x), np.where(direct, a, b), np.where(direct, b, a)
    c, d = np.ones_like(y), 1 / (1 - (a + b) * y / (a + 1))
    h, m, done = d.copy(), 0, False
    while not done:
        m += 1
        for t in (m * (b - m) * y / ((a - 1 + 2 * m) * (a + 2 * m)), -(a + m) * (a + b + m) * y / ((a + 2 * m) * (a + 1 + 2 * m))):
            c, d = 1 + t / c, 1 / (1 + t * d)
            h = h * c * d
        done = bool((np.abs(c * d - 1) < 1e-14).all()) or m > 50 + 10 * math.sqrt(max(a.max(), b.max()))
    part = np.exp(_log_gamma(a + b) - _log_gamma(a) - _log_gamma(b) + a * np.log(y) + b * np.log1p(-y)) * h / a
    return np.where(direct, part, 1 - part)


def bounds(k: np.ndarray, n: np.ndarray, level: float, upper: bool) -> np.ndarray:
    """One-sided Clopper-Pearson bounds: beta quantiles by bisection over whole arrays; 1 or 0 at the edges, NaN without a bound."""
    k, n = np.asarray(k, float), np.asarray(n, float)
    valid = (n > 0) & (k >= 0) & (k <= n)
    out = np.where(valid, 1.0 if upper else 0.0, np.nan)
    open_ = valid & (k < n if upper else k > 0)
    if open_.any():
        a, b = (k[open_] + 1, n[open_] - k[open_]) if upper else (k[open_], n[open_] - k[open_] + 1)
        goal = level if upper else 1 - level
        low, high = np.zeros(len(a)), np.ones(len(a))
        for _ in range(54):
            at = (low + high) / 2
            below = beta_cdf(at, a, b) < goal
            low, high = np.where(below, at, low), np.where(below, high, at)
        out[open_] = (low + high) / 2
    return out


def bound(k: int, n: int, level: float, upper: bool) -> float | None:
    """One bound of bounds(), None without one."""
    value = float(bounds(np.array([k]), np.array([n]), level, upper)[0])
    return None if math.isnan(value) else value


def clopper_pearson(k: Column, n: Column, level: float = 0.95, upper: bool = True) -> Column:
    @F.pandas_udf("double")
    def run(ks: pd.Series, ns: pd.Series) -> pd.Series:
        found = bounds(ks.to_numpy(float, na_value=np.nan), ns.to_numpy(float, na_value=np.nan), level, upper)
        return pd.Series(found).astype(object).where(~np.isnan(found), None).astype("Float64")

    return run(k, n)


#: Buckets that a bootstrap's distinct clusters are dealt over.
DRAW_BUCKETS = 64


def bootstrap_interval(rows: DataFrame, hit: str, cluster: str, key: str, replicates: int = 5000, seed: int = 20260921) -> DataFrame:
    """(key, low, high): the 95 % interval of the rate of `hit` over multinomial resamples of a key's clusters.

    Clusters with equal (hits, rows) are one kind with a weight. Every task draws the same split of a replicate's
    clusters over buckets, then its own bucket's part over the kinds in it: together one multinomial draw
    of as many clusters as there are, and no task holds more than one bucket of kinds.
    """
    sums = rows.groupBy(key, cluster).agg(F.sum(F.coalesce(F.col(hit).cast("long"), F.lit(0))).alias("__k"), F.count("*").alias("__n"))
    kinds = sums.groupBy(key, "__k", "__n").agg(F.count("*").alias("__c")).withColumn("__b", F.pmod(F.xxhash64("__k", "__n"), F.lit(DRAW_BUCKETS)).cast("int"))
    sizes = kinds.groupBy(F.col(key).alias("__key"), "__b").agg(F.sum("__c").alias("__size")).groupBy("__key").agg(F.array_sort(F.collect_list(F.struct("__b", "__size"))).alias("__sizes"))
    dealt = kinds.join(sizes, kinds[key].eqNullSafe(sizes["__key"])).drop("__key")

    def draw(pdf: pd.DataFrame) -> pd.DataFrame:
        name, bucket = pdf[key].iloc[0], int(pdf["__b"].iloc[0])
        sizes_ = [(int(s["__b"]), int(s["__size"])) for s in pdf["__sizes"].iloc[0]]
        # Draws depend on the key and the kinds, not on where they are made.
        mark = hash_text("" if name is None else f"={name}")
        whole = sum(s for _, s in sizes_)
        split = np.random.default_rng([seed, mark]).multinomial(whole, [s / whole for _, s in sizes_], replicates)
        left = split[:, [b for b, _ in sizes_].index(bucket)].astype(np.int64)
        own, rest = np.random.default_rng([seed, mark, bucket]), int(pdf["__c"].sum())
        k, n = np.zeros(replicates), np.zeros(replicates)
        for hits, size, weight in pdf.sort_values(["__k", "__n"])[["__k", "__n", "__c"]].itertuples(index=False):
            w = own.binomial(left, min(1.0, weight / rest))
            left, rest = left - w, rest - weight
            k += w * hits
            n += w * size
        return pd.DataFrame({key: [name] * replicates, "__r": np.arange(replicates), "__k": k, "__n": n})

    kind = rows.schema[key].dataType.simpleString()
    drawn = dealt.groupBy(key, "__b").applyInPandas(draw, f"{key} {kind}, __r int, __k double, __n double").groupBy(key, "__r").agg(F.sum("__k").alias("__k"), F.sum("__n").alias("__n"))
    share = F.col("__k") / F.nullif(F.col("__n"), F.lit(0.0))
    both = drawn.groupBy(key).agg(F.percentile(share, F.array(F.lit(0.025), F.lit(0.975))).alias("__q"))
    return both.select(key, F.col("__q")[0].alias("low"), F.col("__q")[1].alias("high"))


def hash_text(text: str) -> int:
    import hashlib

    return int.from_bytes(hashlib.sha256(text.encode()).digest()[:8], "big")


def pair_counts(incidence: DataFrame, label: str, case: str) -> DataFrame:
    """(case, label) rows -> every pair of labels that share a case, with counts of both and either.

    One row a case and label is enough; pairs come from a self join by case (cases hold few labels).
    """
    base = incidence.select(case, label).distinct()
    single = base.groupBy(label).agg(F.count("*").alias("n"))
    left = base.select(case, F.col(label).alias("a"))
    right = base.select(case, F.col(label).alias("b"))
    both = left.join(right, case).where("a < b").groupBy("a", "b").agg(F.count("*").alias("both"))
    out = both.join(single.select(F.col(label).alias("a"), F.col("n").alias("left_n")), "a").join(single.select(F.col(label).alias("b"), F.col("n").alias("right_n")), "b")
    return out.select("a", "b", "both", "left_n", "right_n")


def merge_signal(both: Column, left: Column, right: Column, same_share: Column, support: int = 10) -> Column:
    """merge / co-occurrence / absorption / none from pair counts and the share of cases in which both serve one requirement."""
    high = F.greatest(both / left, both / right)
    low = F.least(both / left, both / right)
    merge = (left >= support) & (right >= support) & (low >= 0.8)
    absorb = (both >= support) & (high >= 0.9) & (low <= 0.5)
    return F.when(merge & (same_share >= 0.5), "merge").when(merge, "co-occurrence").when(absorb & (same_share >= 0.5), "absorption").when(absorb, "co-occurrence").otherwise("none")


def frequency_class(hits: Column, total: Column) -> Column:
    return F.when(hits == 0, "zero").when(hits <= 5, "1-5").when(hits / total < 0.01, "<1%").otherwise("other")
