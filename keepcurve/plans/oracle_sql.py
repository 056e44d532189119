"""SQL text for the DuckDB oracle: feature groups over the role tables.

Each helper returns a SELECT usable as a CTE body after
``keepcurve.sources.testdata.role_sql(period)``.
"""

from __future__ import annotations

from keepcurve.operators.features import LOOKBACK_WINDOWS_DAYS as WINDOWS


def r(expr: str, d: int = 6) -> str:
    return f"round({expr}, {d})"


def member_features_sql(cutoff: str) -> str:
    return f"""SELECT msno, city, CASE WHEN bd BETWEEN 10 AND 90 THEN bd END AS age,
       coalesce(bd BETWEEN 10 AND 90, false) AS age_is_valid,
       CASE WHEN gender = 'male' THEN 1 WHEN gender = 'female' THEN 0 END AS gender_male,
       registered_via, CAST(DATE '{cutoff}' - registration_date AS INTEGER) AS tenure_days
FROM members"""


def tx_asof_sql(cutoff: str, src: str = "tx_p") -> str:
    return f"""SELECT *, CAST(DATE '{cutoff}' - transaction_date AS INTEGER) AS days_before_cutoff
FROM {src} WHERE transaction_date <= DATE '{cutoff}'"""


def tx_latest_sql(cutoff: str, src: str = "tx_asof") -> str:
    return f"""SELECT msno, payment_method_id AS last_payment_method_id,
       payment_plan_days AS last_payment_plan_days, plan_list_price AS last_plan_list_price,
       actual_amount_paid AS last_actual_amount_paid, is_auto_renew,
       days_before_cutoff AS days_since_last_transaction,
       CAST(membership_expire_date - DATE '{cutoff}' AS INTEGER) AS membership_expires_in_days
FROM (SELECT *, row_number() OVER (PARTITION BY msno ORDER BY transaction_date DESC, tx_id DESC) AS rn
      FROM {src}) WHERE rn = 1"""


def tx_window_sql(src: str = "tx_asof", rounded: bool = False) -> str:
    wins = ",\n       ".join(f"count(*) FILTER (WHERE days_before_cutoff <= {d}) AS n_transactions_last_{d}d"
                            for d in WINDOWS)
    avg = "avg(plan_list_price - actual_amount_paid)"
    return f"""SELECT msno, {wins},
       count(DISTINCT CASE WHEN days_before_cutoff <= 180 THEN plan_list_price END) AS n_distinct_plans_last_180d,
       CAST(sum(is_cancel) AS BIGINT) AS n_cancellations_lifetime,
       count(*) AS n_transactions_lifetime,
       {r(avg) if rounded else avg} AS avg_discount_lifetime
FROM {src} GROUP BY msno"""


def log_daily_sql(cutoff: str, src: str = "logs_p", cohort: str | None = "labels_p") -> str:
    where = f"log_date <= DATE '{cutoff}'"
    if cohort:
        where += f" AND msno IN (SELECT msno FROM {cohort})"
    sums = ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}"
                     for c in ("num_25", "num_50", "num_75", "num_985", "num_100", "num_unq"))
    return f"""SELECT msno, log_date, {sums},
       sum(total_secs) AS total_secs, CAST(DATE '{cutoff}' - log_date AS INTEGER) AS dbc
FROM {src} WHERE {where} GROUP BY msno, log_date"""


def log_features_sql(src: str = "log_daily", rounded: bool = False) -> str:
    rr = (lambda e: r(e)) if rounded else (lambda e: e)
    cols = []
    for d in WINDOWS:
        cols += [f"{rr(f'sum(CASE WHEN dbc <= {d} THEN total_secs ELSE 0 END)')} AS total_secs_last_{d}d",
                 f"CAST(sum(CASE WHEN dbc <= {d} THEN num_100 ELSE 0 END) AS BIGINT) AS num_100_last_{d}d",
                 f"CAST(sum(CASE WHEN dbc <= {d} THEN num_unq ELSE 0 END) AS BIGINT) AS num_unq_last_{d}d",
                 f"count(*) FILTER (WHERE dbc <= {d}) AS active_days_last_{d}d"]
    plays = ["num_25", "num_50", "num_75", "num_985", "num_100"]
    cols.append("min(dbc) AS days_since_last_log")
    cols += [f"CAST(sum({p}) AS BIGINT) AS {p}_lifetime" for p in plays]
    total = " + ".join(f"sum({p})" for p in plays)
    cols.append(f"{rr(f'CASE WHEN ({total}) > 0 THEN CAST(sum(num_100) AS DOUBLE) / ({total}) END')} AS completion_ratio")
    prior = "sum(CASE WHEN dbc > 30 AND dbc <= 60 THEN total_secs ELSE 0 END)"
    recent = "sum(CASE WHEN dbc <= 30 THEN total_secs ELSE 0 END)"
    cols.append(f"{rr(f'CASE WHEN {prior} > 0 THEN {recent} / {prior} END')} AS engagement_momentum")
    return "SELECT msno, " + ",\n       ".join(cols) + f"\nFROM {src} GROUP BY msno"


def snapshot_ctes(period: str, cutoff: str, suffix: str = "") -> str:
    """CTEs member_f, tx_asof, tx_latest, tx_win, log_daily, log_f and snap (+suffix)."""
    s = suffix
    return f""",
member_f{s} AS ({member_features_sql(cutoff)}),
tx_asof{s} AS ({tx_asof_sql(cutoff, 'tx_p' + s)}),
tx_latest{s} AS ({tx_latest_sql(cutoff, 'tx_asof' + s)}),
tx_win{s} AS ({tx_window_sql('tx_asof' + s)}),
log_daily{s} AS ({log_daily_sql(cutoff, 'logs_p' + s, 'labels_p' + s)}),
log_f{s} AS ({log_features_sql('log_daily' + s)}),
snap{s} AS (
  SELECT l.*, m.* EXCLUDE (msno), t.* EXCLUDE (msno), g.* EXCLUDE (msno),
         '{period}' AS period, DATE '{cutoff}' AS cutoff_date
  FROM labels_p{s} l
  LEFT JOIN member_f{s} m USING (msno)
  LEFT JOIN (SELECT * FROM tx_latest{s} JOIN tx_win{s} USING (msno)) t USING (msno)
  LEFT JOIN log_f{s} g USING (msno)
)"""
