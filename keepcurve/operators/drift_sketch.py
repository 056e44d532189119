"""PSI from mergeable quantile sketches.

One aggregate per delivery or period makes a KLL sketch of every feature; the
sketches are small rows that can be stored and merged, so a report over any
union of deliveries reads no feature row again.  Up to ``k`` values a sketch
is exact, and the report equals ``drift.drift_report``.  Beyond, ranks are
off by at most ``rank_error(k)`` of the values with 99 % confidence (sketches
are read as their values at 4 k even ranks, which adds 1 / (4 k)); each
report row carries the interval in which the exact PSI then lies, from the
intervals of the edges and of both sides' shares (as long as equal edges
collapse alike).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keepcurve.operators.drift import N_BINS, status

K = 4096


def rank_error(k: int) -> float:
    """One-sided normalised rank error of a KLL sketch, 99 % confidence."""
    return 2.296 / k ** 0.9723


def feature_sketches(df: DataFrame, features: Sequence[str], keys: Sequence[str] = (), k: int = K) -> DataFrame:
    """``(*keys, feature, sketch)`` in one aggregate; nulls and NaN are left
    out, and a feature without a value has an empty sketch."""
    value = lambda c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
    wide = df.groupBy(*keys).agg(*[F.kll_sketch_agg_double(value(c), F.lit(k)).alias(f"_s{i}") for i, c in enumerate(features)])
    rows = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"_s{i}").alias("sketch")) for i, c in enumerate(features)])
    return wide.select(*keys, F.explode(rows).alias("_r")).select(*keys, "_r.*")


def merge_sketches(sketches: DataFrame, keys: Sequence[str] = (), k: int = K) -> DataFrame:
    """Sketches of several deliveries as one per ``keys`` and feature."""
    return sketches.groupBy(*keys, "feature").agg(F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"))


def _grid(sketch: Column, k: int) -> Column:
    """Values at 4 k even ranks: with up to k values, every one of them, its
    share to less than half a value."""
    ranks = ",".join(repr((j + 0.5) / (4 * k)) for j in range(4 * k))
    return F.kll_sketch_get_quantile_double(sketch, F.split(F.lit(ranks), ",").cast("array<double>"))


def _at(grid: Column, n: Column, position: Column, k: int) -> Column:
    """Value at a 0-based position of the order, kept inside it."""
    p = F.greatest(F.lit(0.0), F.least(position.cast("double"), n - 1))
    return F.get(grid, F.least(F.floor((p + 0.5) / n * (4 * k)), F.lit(4 * k - 1)).cast("int"))


def _share(grid: Column, value: Column, k: int) -> Column:
    """``(below, upto)``: shares of values below and up to ``value``; values
    within a few units in the last place of it count as equal."""
    near = F.greatest(F.abs(value) * F.lit(2.0 ** -50), F.lit(5e-324))
    count = lambda bound: F.size(F.filter(grid, lambda x: x <= bound)) / F.lit(4.0 * k)
    return F.struct(count(value - near).alias("below"), count(value + near).alias("upto"))


def psi_from_sketches(reference: DataFrame, current: DataFrame, n_bins: int = N_BINS, k: int = K, open_ended: bool = False) -> DataFrame:
    """R1 for every feature of two sketch tables ``(feature, sketch)``:
    ``(feature, psi, psi_low, psi_high, n_reference, n_current)``.

    Edges, bins and smoothing are those of ``drift.psi_by_feature``;
    ``open_ended`` counts values outside the reference range into the end
    bins instead of dropping them.  A side without values gives null, a
    feature with fewer than three distinct edges 0."""
    error = F.lit(rank_error(k) + 1 / (4 * k))
    both = reference.select("feature", F.col("sketch").alias("rs")).join(current.select("feature", F.col("sketch").alias("cs")), "feature", "full")
    both = both.withColumns({"rn": F.coalesce(F.kll_sketch_get_n_double("rs"), F.lit(0)).cast("double"),
                             "cn": F.coalesce(F.kll_sketch_get_n_double("cs"), F.lit(0)).cast("double")})
    e = both.where("rn > 0 AND cn > 0").withColumns({
        "r": _grid(F.col("rs"), k), "c": _grid(F.col("cs"), k), "re": F.when(F.col("rn") < k, 0.0).otherwise(error),
        "ce": F.when(F.col("cn") < k, 0.0).otherwise(error)})
    rn, rg = F.col("rn"), F.col("r")

    def edge(i):
        h = (rn - 1) * i / n_bins
        low, high = _at(rg, rn, F.floor(h), k), _at(rg, rn, F.ceil(h), k)
        at = low + (h - F.floor(h)) * (high - low)
        return F.struct(at.alias("edge"), F.least(at, _at(rg, rn, F.floor(h) - F.col("re") * rn, k)).alias("edge_low"),
                        F.greatest(at, _at(rg, rn, F.ceil(h) + F.col("re") * rn, k)).alias("edge_high"))

    e = e.withColumn("marks", F.transform(F.sequence(F.lit(0), F.lit(n_bins)), edge))
    shares = lambda x: F.struct(x["edge"].alias("edge"), *[_share(F.col(s), x[m], k).alias(f"{s}_{m}")
                                                          for s in "rc" for m in ("edge", "edge_low", "edge_high")])
    e = e.select("feature", "rn", "cn", "re", "ce", F.explode(F.transform("marks", shares)).alias("m")).select("feature", "rn", "cn", "re", "ce", "m.*")
    # equal edges are one; its interval covers theirs
    pair = [f"{s}_{m}" for s in "rc" for m in ("edge", "edge_low", "edge_high")]
    e = e.groupBy("feature", "edge").agg(*[(F.max if c.endswith("high") else F.min)(c).alias(c) for c in pair],
                                         *[F.first(c).alias(c) for c in ("rn", "cn", "re", "ce")])
    order = Window.partitionBy("feature").orderBy("edge")
    e = e.withColumns({"place": F.row_number().over(order), "edges": F.count("*").over(Window.partitionBy("feature"))})
    last, first = F.col("place") == F.col("edges"), F.col("place") == 1
    ends = (lambda x: F.when(first, 0.0).when(last, 1.0).otherwise(x)) if open_ended else (lambda x: x)
    for s in "rc":
        err = F.col(f"{s}e")
        upto = lambda m: F.when(last, F.col(f"{s}_{m}.upto")).otherwise(F.col(f"{s}_{m}.below"))  # noqa: E731, B023
        e = e.withColumns({s: ends(upto("edge")), f"{s}_low": ends(F.greatest(F.lit(0.0), upto("edge_low") - err)),
                           f"{s}_high": ends(F.least(F.lit(1.0), upto("edge_high") + err))})
    every = Window.partitionBy("feature")
    step = {}
    for s in "rc":
        n = F.col(f"{s}n")
        step[f"{s}_count"] = F.round((F.lead(s).over(order) - F.col(s)) * n)
        step[f"{s}_less"] = F.greatest(F.lit(0.0), F.lead(f"{s}_low").over(order) - F.col(f"{s}_high")) * n
        step[f"{s}_more"] = (F.lead(f"{s}_high").over(order) - F.col(f"{s}_low")) * n
        span = lambda a, b: (F.max(F.when(last, F.col(a))).over(every) - F.max(F.when(first, F.col(b))).over(every)) * n  # noqa: E731, B023
        step[f"{s}_total"] = F.round(span(s, s))
        step[f"{s}_total_low"], step[f"{s}_total_high"] = F.greatest(F.lit(0.0), span(f"{s}_low", f"{s}_high")), span(f"{s}_high", f"{s}_low")
    bins = e.withColumns(step).where("place < edges OR edges = 1")
    share = lambda s, kind, total: (F.col(f"{s}_{kind}") + 1) / (F.col(f"{s}_{total}") + n_bins)
    term = lambda c, r: (c - r) * F.ln(c / r)
    r, c = share("r", "count", "total"), share("c", "count", "total")
    exact = (F.col("re") == 0) & (F.col("ce") == 0)
    r0, r1 = share("r", "less", "total_high"), share("r", "more", "total_low")
    c0, c1 = share("c", "less", "total_high"), share("c", "more", "total_low")
    least = F.when(c0 > r1, term(c0, r1)).when(r0 > c1, term(c1, r0)).otherwise(0.0)
    most = F.greatest(term(c0, r0), term(c0, r1), term(c1, r0), term(c1, r1))  # convex: largest at a corner
    psi = bins.groupBy("feature").agg(F.first("edges").alias("edges"), F.sum(term(c, r)).alias("psi"), F.sum(F.when(exact, term(c, r)).otherwise(least)).alias("psi_low"),
                                      F.sum(F.when(exact, term(c, r)).otherwise(most)).alias("psi_high"))
    out = both.select("feature", F.col("rn").cast("long").alias("n_reference"), F.col("cn").cast("long").alias("n_current")).join(psi, "feature", "left")
    value = lambda x: F.when(F.col("edges") < 3, 0.0).otherwise(F.col(x)).alias(x)
    return out.select("feature", value("psi"), value("psi_low"), value("psi_high"), "n_reference", "n_current")


def drift_report_from_sketches(reference: DataFrame, current: DataFrame, n_bins: int = N_BINS, k: int = K, open_ended: bool = False) -> DataFrame:
    """R2: PSI with its interval and the status of every feature."""
    p = psi_from_sketches(reference, current, n_bins, k, open_ended)
    return p.select("feature", "psi", status(F.col("psi")).alias("status"), "psi_low", "psi_high")
