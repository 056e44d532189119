"""As-of feature snapshots.

A feature is a row of a table: a name, what it measures, the ages (days
before the cutoff) it covers and how it is aggregated.  ``aggregates`` turns
such rows into columns of one grouped aggregate, so adding a window or a
measure is adding a row.  Rows dated after the cutoff are dropped before any
aggregate (leakage guard, inclusive ``<=``); a window of d days covers ages
0 to d.

Plan shape (per source table):
  * transactions: one member aggregate; the latest row's fields come from
    ``max_by`` with a decimal order key (date, then id).  Distinct plans are
    the distinct (member, list price) pairs of the window's rows alone, two
    columns wide, which enter that aggregate as rows of their own, so wide rows
    meet one shuffle and no join.  All buffers are fixed-width, so both are
    hash aggregates with a map-side partial; no Expand, no window that sorts a
    hot member's rows in one task.
  * logs: one member aggregate over the raw rows.  Days with activity are bits
    of a few longs (``bit_or``), counted per window with a mask, so days are
    distinct without a shuffle by day.
  * cohort filter: rows of members outside the cohort go before the
    aggregate, by a bitmap of hashed keys of fixed size (``bloom.prefilter``;
    the log table is not shuffled for it); the few that pass by chance go in
    an exact left-semi join of the aggregated rows, or in the snapshot's own
    left join.
  * several cutoffs: rows are tagged with each period they precede after one
    scan, and the aggregates are keyed by (period, member).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keepcurve.functions.dates import as_date, cutoff_lit
from keepcurve.functions.exprs import guarded_ratio, range_guard, recode, valid_flag
from keepcurve.operators.bloom import prefilter

# Windows, ranges, codes and source columns of the feature set.
LOOKBACK_WINDOWS_DAYS = (7, 30, 90, 180)
AGE_RANGE = (10, 90)
GENDER_CODES = {"male": 1, "female": 0}
DISTINCT_PLAN_WINDOW_DAYS = 180
MOMENTUM_RECENT_DAYS = 30
MOMENTUM_PRIOR_END_DAYS = 60
PLAY_COLUMNS = ("num_25", "num_50", "num_75", "num_985", "num_100")
WINDOWED_LOG_MEASURES = ("total_secs", "num_100", "num_unq")
LATEST_TX_FIELDS = {
    "payment_method_id": "last_payment_method_id",
    "payment_plan_days": "last_payment_plan_days",
    "plan_list_price": "last_plan_list_price",
    "actual_amount_paid": "last_actual_amount_paid",
    "is_auto_renew": "is_auto_renew",
}

AGE = "days_before_cutoff"
BITS = 64


@dataclass(frozen=True)
class Feature:
    """``name`` = ``how`` (sum, count, min, max) of ``measure`` (a column name;
    none for rows) over ages from ``ages[0]`` to ``ages[1]`` (none: all)."""

    name: str
    how: str
    measure: str | None = None
    ages: tuple[int, int] | None = None

    def column(self) -> Column:
        inside = F.lit(True) if self.ages is None else F.col(AGE).between(*self.ages)
        if self.how == "count":
            out = F.count_if(inside) if self.measure is None else F.count(F.when(inside, F.col(self.measure)))
        elif self.ages is None:
            out = getattr(F, self.how)(self.measure)
        else:
            empty = F.lit(0) if self.how == "sum" else F.lit(None)
            out = getattr(F, self.how)(F.when(inside, F.col(self.measure)).otherwise(empty))
        return out.alias(self.name)


def aggregates(features: Sequence[Feature]) -> list[Column]:
    return [f.column() for f in features]


def _semi(df: DataFrame, cohort: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    return df if cohort is None else df.join(cohort.select(*keys), list(keys), "left_semi")


def _may_be_in(df: DataFrame, cohort: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    return df if cohort is None else prefilter(df, cohort.select(*keys), keys)


# ------------------------------------------------------------------ members

def member_features(members: DataFrame, cutoff, key: str = "msno",
                    registration_col: str | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Cleaned static member attributes and tenure at the cutoff."""
    if registration_col is None:
        registration_col = ("registration_date" if "registration_date" in members.columns
                            else "registration_init_time")
    age = F.col("bd")
    columns: Mapping[str, Column] = {
        "city": F.col("city").cast("int"),
        "age": range_guard(age, *AGE_RANGE).cast("int"),
        "age_is_valid": valid_flag(age, *AGE_RANGE),
        "gender_male": recode(F.col("gender"), GENDER_CODES).cast("int"),
        "registered_via": F.col("registered_via").cast("int"),
        "tenure_days": F.datediff(cutoff_lit(cutoff), as_date(members, registration_col)),
    }
    return members.select(*keep, key, *[c.alias(n) for n, c in columns.items()])


# ------------------------------------------------------------- transactions

def asof_filter(df: DataFrame, date_col: str, cutoff, out_date: str | None = None) -> DataFrame:
    """P6 + P7: keep rows dated on/before the cutoff; add ``days_before_cutoff``.

    The predicate is on the raw column when it is already a date/timestamp,
    so Parquet sources get it as a pushed filter.
    """
    d = as_date(df, date_col)
    out_date = out_date or date_col
    return (df.where(d <= cutoff_lit(cutoff))
              .withColumn(out_date, d)
              .withColumn(AGE, F.datediff(cutoff_lit(cutoff), F.col(out_date))))


def _tx_as_of(tx: DataFrame, cutoff) -> DataFrame:
    t = asof_filter(tx.withColumn("membership_expire_date", as_date(tx, "membership_expire_date")), "transaction_date", cutoff)
    return _tx_measures(t, cutoff_lit(cutoff))


def _tx_measures(t: DataFrame, cutoff: Column) -> DataFrame:
    return (t.withColumn("membership_expires_in_days", F.datediff(F.col("membership_expire_date"), cutoff))
             .withColumn("discount", F.col("plan_list_price") - F.col("actual_amount_paid"))
             .withColumn("cancelled", F.col("is_cancel").cast("long")))


LATEST_COLUMNS = {**LATEST_TX_FIELDS, AGE: "days_since_last_transaction",
                  "membership_expires_in_days": "membership_expires_in_days"}


def _recency(t: DataFrame, tie_break: str | None) -> Column:
    """Order of a member's transactions: date, then the unique id.

    With an integral id this is one decimal (ids stay below 10^19), which an
    aggregate buffer holds in place; a null id comes before any other of its
    day.  Without one the row's fields decide."""
    if tie_break in t.columns and isinstance(t.schema[tie_break].dataType, T.IntegralType):
        day = F.unix_date("transaction_date").cast("decimal(18,0)") * F.lit(Decimal(10 ** 20)).cast("decimal(21,0)")
        no_id = F.lit(Decimal(-(2 ** 63) - 1)).cast("decimal(38,0)")
        return (day.cast("decimal(38,0)") + F.coalesce(F.col(tie_break).cast("decimal(38,0)"), no_id)).cast("decimal(38,0)")
    rest = [tie_break] if tie_break in t.columns else [*LATEST_TX_FIELDS, "membership_expire_date"]
    return F.struct("transaction_date", *rest)


def _windowed_tx(windows: Sequence[int]) -> list[Feature]:
    return [*(Feature(f"n_transactions_last_{d}d", "count", ages=(0, d)) for d in windows),
            Feature("n_cancellations_lifetime", "sum", "cancelled"),
            Feature("n_transactions_lifetime", "count", "_row"),
            Feature("_discount", "sum", "discount"), Feature("_discounts", "count", "discount")]


def _latest(t: DataFrame, keys: Sequence[str], tie_break: str | None) -> DataFrame:
    t = t.withColumn("_recency", _recency(t, tie_break))
    return t.groupBy(*keys).agg(*[F.max_by(c, "_recency").alias(n) for c, n in LATEST_COLUMNS.items()])


def _tx_member_aggregate(t: DataFrame, keys: Sequence[str], windows: Sequence[int], tie_break: str | None,
                         latest: bool) -> DataFrame:
    return _tx_totals(t.withColumn("_row", F.lit(1)), _plans_in_window(t, keys), keys, windows, _windowed_tx(windows), tie_break, latest)


def _plans_in_window(t: DataFrame, keys: Sequence[str]) -> DataFrame:
    inside = F.col(AGE).between(0, DISTINCT_PLAN_WINDOW_DAYS) & F.col("plan_list_price").isNotNull()
    return t.where(inside).select(*keys, "plan_list_price").distinct()


def _tx_totals(rows: DataFrame, plans: DataFrame, keys: Sequence[str], windows: Sequence[int], features: Sequence[Feature],
               tie_break: str | None, latest: bool) -> DataFrame:
    """One aggregate per member over its transactions (or states of them) and,
    below them, a row for each of the member's list prices in the plan window."""
    state = []
    if latest:
        rows = rows.withColumn("_recency", _recency(rows, tie_break))
        state = [F.max_by(c, "_recency").alias(n) for c, n in LATEST_COLUMNS.items()]
    distinct = f"n_distinct_plans_last_{DISTINCT_PLAN_WINDOW_DAYS}d"
    both = rows.unionByName(plans.select(*keys, F.lit(1).alias("_plan")), allowMissingColumns=True)
    out = both.groupBy(*keys).agg(*state, *aggregates(features), F.count("_plan").alias(distinct))
    names = [n for n in LATEST_COLUMNS.values() if latest] + [f"n_transactions_last_{d}d" for d in windows]
    mean = F.when(F.col("_discounts") > 0, F.col("_discount") / F.col("_discounts"))
    return out.select(*keys, *names, distinct, "n_cancellations_lifetime", "n_transactions_lifetime",
                      mean.alias("avg_discount_lifetime"))


def latest_transaction(tx: DataFrame, cutoff, key: str = "msno", tie_break: str | None = "tx_id",
                       cohort: DataFrame | None = None) -> DataFrame:
    """W1 + P7 + P8: current plan/payment state = latest transaction as of cutoff."""
    return _semi(_latest(_may_be_in(_tx_as_of(tx, cutoff), cohort, [key]), [key], tie_break), cohort, [key])


def transaction_window_features(tx: DataFrame, cutoff, key: str = "msno",
                                windows: Sequence[int] = LOOKBACK_WINDOWS_DAYS,
                                cohort: DataFrame | None = None) -> DataFrame:
    """Windowed counts, distinct plans, lifetime sums/avg."""
    return _semi(_tx_member_aggregate(_may_be_in(_tx_as_of(tx, cutoff), cohort, [key]), [key], windows, None, latest=False), cohort, [key])


def transaction_features(tx: DataFrame, cutoff, key: str = "msno", tie_break: str | None = "tx_id",
                         windows: Sequence[int] = LOOKBACK_WINDOWS_DAYS,
                         cohort: DataFrame | None = None) -> DataFrame:
    """Latest state and window aggregates together (no self-join)."""
    return _semi(_tx_member_aggregate(_may_be_in(_tx_as_of(tx, cutoff), cohort, [key]), [key], windows, tie_break, latest=True), cohort, [key])


# --------------------------------------------------------------- user logs

def _log_date(logs: DataFrame, date_col: str | None) -> Column:
    return as_date(logs, date_col or ("log_date" if "log_date" in logs.columns else "date"))


def daily_activity(logs: DataFrame, cutoff, key: str = "msno", date_col: str | None = None) -> DataFrame:
    """One row per (member, active day) on/before the cutoff, measures summed."""
    d = _log_date(logs, date_col)
    return (logs.where(d <= cutoff_lit(cutoff))
                .groupBy(F.col(key), d.alias("log_date"))
                .agg(*aggregates([Feature(m, "sum", m) for m in [*PLAY_COLUMNS, "num_unq", "total_secs"]]))
                .withColumn(AGE, F.datediff(cutoff_lit(cutoff), F.col("log_date"))))


def _logs_as_of(logs: DataFrame, cutoff, date_col: str | None) -> DataFrame:
    d = _log_date(logs, date_col)
    return logs.where(d <= cutoff_lit(cutoff)).withColumn("log_date", d).withColumn(
        AGE, F.datediff(cutoff_lit(cutoff), F.col("log_date")))


def user_log_features(logs: DataFrame, cutoff, key: str = "msno", cohort: DataFrame | None = None,
                      windows: Sequence[int] = LOOKBACK_WINDOWS_DAYS, date_col: str | None = None) -> DataFrame:
    """Window sums, active days, lifetime sums,
    completion ratio and engagement momentum, all from one member aggregate."""
    rows = _may_be_in(_logs_as_of(logs, cutoff, date_col), cohort, [key])
    return _semi(_log_member_aggregate(rows, [key], windows), cohort, [key])


def _day_bits(longest: int) -> list[Column]:
    """Long k has a bit for each active day of ages 64 k to 64 k + 63."""
    age = F.col(AGE)
    flag = F.expr(f"shiftleft(1L, {AGE} % {BITS})")
    return [F.bit_or(F.when(F.floor(age / BITS) == k, flag)).alias(f"_days{k}") for k in range(longest // BITS + 1)]


def _active_days(window: int) -> Column:
    """Days of ages 0 to ``window`` that have a bit."""
    total = F.lit(0)
    for k in range(window // BITS + 1):
        n = min(BITS, window + 1 - k * BITS)
        mask = -1 if n == BITS else (1 << n) - 1
        total = total + F.coalesce(F.bit_count(F.col(f"_days{k}").bitwiseAND(F.lit(mask).cast("long"))), F.lit(0))
    return total.cast("long").alias(f"active_days_last_{window}d")


def _log_member_aggregate(logs: DataFrame, keys: Sequence[str], windows: Sequence[int]) -> DataFrame:
    features = [Feature(f"{m}_last_{d}d", "sum", m, (0, d)) for d in windows for m in WINDOWED_LOG_MEASURES]
    features += [Feature(f"{c}_lifetime", "sum", c) for c in PLAY_COLUMNS]
    features += [Feature("days_since_last_log", "min", AGE),
                 Feature("_recent_secs", "sum", "total_secs", (0, MOMENTUM_RECENT_DAYS)),
                 Feature("_prior_secs", "sum", "total_secs", (MOMENTUM_RECENT_DAYS + 1, MOMENTUM_PRIOR_END_DAYS))]
    agg = logs.groupBy(*keys).agg(*aggregates(features), *_day_bits(max(windows)))
    plays: Callable[[], Column] = lambda: sum((F.col(f"{c}_lifetime") for c in PLAY_COLUMNS), F.lit(0))
    ratios = {"completion_ratio": guarded_ratio(F.col("num_100_lifetime"), plays()),
              "engagement_momentum": guarded_ratio(F.col("_recent_secs"), F.col("_prior_secs"))}
    by_window = [c for d in windows for c in [*(F.col(f"{m}_last_{d}d") for m in WINDOWED_LOG_MEASURES), _active_days(d)]]
    return agg.select(*keys, *by_window, "days_since_last_log", *[F.col(f"{c}_lifetime").cast("long").alias(f"{c}_lifetime") for c in PLAY_COLUMNS],
                      *[c.alias(n) for n, c in ratios.items()])


# ----------------------------------------------------------------- assembly

def _assemble(labels: DataFrame, keys: Sequence[str], groups: Sequence[DataFrame]) -> DataFrame:
    """Left joins on the keys; members without a group's rows keep nulls."""
    out = labels
    for g in groups:
        out = out.join(g, list(keys), "left")
    return out


def feature_snapshot(labels: DataFrame, members: DataFrame, transactions: DataFrame, logs: DataFrame,
                     cutoff, period: str, key: str = "msno", tie_break: str | None = "tx_id",
                     windows: Sequence[int] = LOOKBACK_WINDOWS_DAYS) -> DataFrame:
    """J5 + P12: one row per labelled member, left-joined to every feature group.

    All inputs are keyed by member, so the joins are co-partitioned on the
    key (sort-merge) or broadcast when a side is measured small.
    """
    cohort = labels.select(key)
    groups = [member_features(members, cutoff, key),
              transaction_features(transactions, cutoff, key, tie_break, windows, cohort=cohort),
              user_log_features(logs, cutoff, key, cohort=cohort, windows=windows)]
    return _assemble(labels, [key], groups).withColumns({"period": F.lit(period), "cutoff_date": cutoff_lit(cutoff)})


def feature_snapshots(labels: DataFrame, members: DataFrame, transactions: DataFrame, logs: DataFrame,
                      cutoffs: Mapping[str, object], key: str = "msno", tie_break: str | None = "tx_id",
                      windows: Sequence[int] = LOOKBACK_WINDOWS_DAYS, period_col: str = "period") -> DataFrame:
    """Snapshots for several cutoffs from ONE pass over each source.

    ``labels`` carries a ``period`` column; ``cutoffs`` maps period ->
    cutoff.  Same rows and columns as :func:`feature_snapshot` per period,
    given sources that hold every period's rows (e.g. the union of all
    deliveries).  Each table is read with the latest cutoff pushed to the
    scan; every row is tagged with each period whose cutoff it precedes (at
    most ``len(cutoffs)`` rows out per row in).
    """
    latest = max(str(c)[:10] for c in cutoffs.values())
    tags = F.explode(F.array(*[F.struct(F.lit(p).alias(period_col), cutoff_lit(c).alias("cutoff_date")) for p, c in cutoffs.items()]))
    keys, cut = [period_col, key], F.col("cutoff_date")
    cohort = labels.select(*keys)

    def tagged(df: DataFrame) -> DataFrame:
        return df.select("*", tags.alias("_tag")).select("*", "_tag.*").drop("_tag")

    def visible(df: DataFrame, date_col: str) -> DataFrame:
        return tagged(df).where(F.col(date_col) <= cut).withColumn(AGE, F.datediff(cut, F.col(date_col)))

    tx = asof_filter(transactions.withColumn("membership_expire_date", as_date(transactions, "membership_expire_date")),
                     "transaction_date", latest).drop(AGE)
    tx = _tx_measures(visible(tx, "transaction_date"), cut)
    log_rows = visible(_logs_as_of(logs, latest, None).drop(AGE), "log_date")
    groups = [member_features(tagged(members), cut, key, keep=[period_col]),
              _tx_member_aggregate(_may_be_in(tx, cohort, keys), keys, windows, tie_break, latest=True),
              _log_member_aggregate(_may_be_in(log_rows, cohort, keys), keys, windows)]
    dates = F.create_map(*[x for p, c in cutoffs.items() for x in (F.lit(p), cutoff_lit(c))])
    return _assemble(labels, keys, groups).withColumn("cutoff_date", F.try_element_at(dates, F.col(period_col)))
