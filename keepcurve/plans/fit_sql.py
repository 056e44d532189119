"""SQL that fits small models from raw rows, to hold fitted queries against.

Each helper returns CTEs (text without WITH, no comma at the ends): the fit is
done again in SQL, step by step, not read from what Spark fitted.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence


def boost_ctes(p: str, rows: str, features: Mapping[str, Sequence[float]], trees: int, depth: int, rate: float, loss: str = "logistic",
               l2: float = 1.0, min_child_weight: float = 1.0) -> str:
    """Boosted trees (two at depth 2: the planner takes too long over more) over ``rows`` (columns ``y``, ``w``, ``fit`` and the
    features; trees are grown on rows with ``fit``).  The CTE ``<p>`` has the
    rows with the margin ``m_`` of every row."""
    n = list(range(len(features)))
    bins = ", ".join(f"CASE WHEN {c} IS NULL THEN NULL ELSE {' + '.join(f'CAST({c} > {e} AS INTEGER)' for e in cuts)} END AS b{k}"
                     for k, (c, cuts) in enumerate(features.items()))
    cuts = ", ".join(f"({k}, {len(v)})" for k, v in enumerate(features.values()))
    start = "0.0::DOUBLE" if loss == "logistic" else f"(SELECT sum(y * w) / sum(w) FROM {rows} WHERE fit)::DOUBLE"
    cols = ", ".join(f"b{k}" for k in n)
    gradient = "w * (1 / (1 + exp(-m_)) - y)" if loss == "logistic" else "w * (m_ - y)"
    hessian = "w * (1 / (1 + exp(-m_))) * (1 - 1 / (1 + exp(-m_)))" if loss == "logistic" else "w"
    sc = lambda g, h: f"({g}) * ({g}) / (({h}) + {l2})"
    out = [f"{p}_f(f, nc) AS MATERIALIZED (SELECT * FROM (VALUES {cuts}))",
           f"{p}_m0 AS MATERIALIZED (SELECT row_number() OVER () AS rid_, y::DOUBLE AS y, w::DOUBLE AS w, fit, {bins}, {start} AS m_ FROM (SELECT * FROM {rows}))"]
    for t in range(trees):
        out.append(f"{p}_l{t}_0 AS MATERIALIZED (SELECT rid_, fit, {cols}, {gradient} AS g, {hessian} AS h, 0 AS node FROM {p}_m{t})")
        for d in range(depth):
            here, q = f"{p}_l{t}_{d}", f"{p}_q{t}_{d}"
            out.append(f"""{q}h AS MATERIALIZED (SELECT node, f, b, sum(g) AS g, sum(h) AS h
  FROM (SELECT node, unnest([{', '.join(map(str, n))}]) AS f, unnest([{cols}]) AS b, g, h FROM {here} WHERE fit AND node >= {2 ** d - 1}) GROUP BY ALL)""")
            out.append(f"{q}n AS MATERIALIZED (SELECT node, sum(g) AS tg, sum(h) AS th FROM {q}h WHERE f = 0 GROUP BY node)")
            out.append(f"""{q}c AS MATERIALIZED (SELECT n.node, c.f, c.k, tg, th, coalesce(sum(x.g) FILTER (WHERE x.b <= c.k), 0) AS gl,
    coalesce(sum(x.h) FILTER (WHERE x.b <= c.k), 0) AS hl, coalesce(sum(x.g) FILTER (WHERE x.b IS NULL), 0) AS gm, coalesce(sum(x.h) FILTER (WHERE x.b IS NULL), 0) AS hm
  FROM {q}n n CROSS JOIN (SELECT f, unnest(range(nc + 1)) AS k FROM {p}_f) c LEFT JOIN {q}h x ON x.node = n.node AND x.f = c.f GROUP BY n.node, c.f, c.k, tg, th)""")
            out.append(f"{q}d AS MATERIALIZED (SELECT node, f, k, side, tg, th, gl + side * gm AS gl, hl + side * hm AS hl FROM {q}c, (VALUES (0), (1)) s(side))")
            gain = f"round({sc('gl', 'hl')} + {sc('tg - gl', 'th - hl')} - {sc('tg', 'th')}, 8)"
            out.append(f"""{q}s AS MATERIALIZED (SELECT node, f, k, side FROM (SELECT *, {gain} AS gain FROM {q}d WHERE hl >= {min_child_weight} AND th - hl >= {min_child_weight})
  WHERE gain > 1e-6 QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, k, side) = 1)""")
            value = "CASE s.f " + " ".join(f"WHEN {k} THEN l.b{k}" for k in n) + " END"
            out.append(f"""{p}_l{t}_{d + 1} AS MATERIALIZED (SELECT l.* EXCLUDE (node), CASE WHEN s.node IS NULL THEN l.node
    WHEN coalesce({value} <= s.k, s.side = 1) THEN 2 * l.node + 1 ELSE 2 * l.node + 2 END AS node FROM {here} l LEFT JOIN {q}s s ON s.node = l.node)""")
        out.append(f"{p}_v{t} AS MATERIALIZED (SELECT node, -{rate} * sum(g) / (sum(h) + {l2}) AS v FROM {p}_l{t}_{depth} WHERE fit GROUP BY node)")
        out.append(f"""{p}_m{t + 1} AS MATERIALIZED (SELECT m.* REPLACE (m_ + v AS m_) FROM {p}_m{t} m
  JOIN (SELECT rid_, v FROM {p}_l{t}_{depth} JOIN {p}_v{t} USING (node)) USING (rid_))""")
    out.append(f"{p} AS MATERIALIZED (SELECT r.*, m_ FROM (SELECT *, row_number() OVER () AS rid_ FROM (SELECT * FROM {rows})) r JOIN {p}_m{trees} USING (rid_))")
    return ",\n".join(out)


def boost_levels_ctes(p: str, rows: str, features: Mapping[str, Sequence[float]], trees: int, depth: int, rate: float,
                      l2: float = 1.0, min_child_weight: float = 1.0) -> str:
    """As ``boost_ctes`` with the logistic loss, for any number of trees: a
    recursive CTE grows one level an iteration (and adds a finished tree to the
    margins in one more), so the plan does not grow with the trees.  The
    statement has to begin WITH RECURSIVE."""
    n = list(range(len(features)))
    bins = ", ".join(f"CASE WHEN {c} IS NULL THEN NULL ELSE {' + '.join(f'CAST({c} > {e} AS INTEGER)' for e in cuts)} END AS b{k}"
                     for k, (c, cuts) in enumerate(features.items()))
    cuts = ", ".join(f"({k}, {len(v)})" for k, v in enumerate(features.values()))
    cols = ", ".join(f"b{k}" for k in n)
    sc = lambda g, h: f"({g}) * ({g}) / (({h}) + {l2})"
    gain = f"round({sc('gl', 'hl')} + {sc('tg - gl', 'th - hl')} - {sc('tg', 'th')}, 8)"
    value = "CASE s.f " + " ".join(f"WHEN {k} THEN c.b{k}" for k in n) + " END"
    return f"""{p}_f(f, nc) AS MATERIALIZED (SELECT * FROM (VALUES {cuts})),
{p}_r AS MATERIALIZED (SELECT *, row_number() OVER () AS rid_ FROM {rows}),
{p}_b AS MATERIALIZED (SELECT rid_, y::DOUBLE AS y, w::DOUBLE AS w, fit, {bins} FROM {p}_r),
{p}_s(rid_, step, node, m_) AS (SELECT rid_, 0, 0, 0.0::DOUBLE FROM {p}_b UNION ALL (
  WITH c AS MATERIALIZED (SELECT rid_, step, step % {depth + 1} AS d, node, m_, fit, {cols}, w * (1 / (1 + exp(-m_)) - y) AS g,
         w * (1 / (1 + exp(-m_))) * (1 - 1 / (1 + exp(-m_))) AS h FROM {p}_s JOIN {p}_b USING (rid_) WHERE step < {trees * (depth + 1)}),
  n AS MATERIALIZED (SELECT node, d, sum(g) AS tg, sum(h) AS th FROM c WHERE fit GROUP BY node, d),
  x AS MATERIALIZED (SELECT node, f, b, sum(g) AS g, sum(h) AS h FROM (SELECT node, unnest([{', '.join(map(str, n))}]) AS f, unnest([{cols}]) AS b, g, h
         FROM c WHERE fit AND d < {depth} AND node >= (1 << d) - 1) GROUP BY ALL),
  k AS MATERIALIZED (SELECT n.node, e.f, e.k, tg, th, coalesce(sum(x.g) FILTER (WHERE x.b <= e.k), 0) AS gl, coalesce(sum(x.h) FILTER (WHERE x.b <= e.k), 0) AS hl,
         coalesce(sum(x.g) FILTER (WHERE x.b IS NULL), 0) AS gm, coalesce(sum(x.h) FILTER (WHERE x.b IS NULL), 0) AS hm
       FROM n CROSS JOIN (SELECT f, unnest(range(nc + 1)) AS k FROM {p}_f) e LEFT JOIN x ON x.node = n.node AND x.f = e.f
       WHERE n.d < {depth} AND n.node >= (1 << n.d) - 1 GROUP BY n.node, e.f, e.k, tg, th),
  s AS MATERIALIZED (SELECT node, f, k, side FROM (SELECT *, {gain} AS gain FROM (
         SELECT node, f, k, side, tg, th, gl + side * gm AS gl, hl + side * hm AS hl FROM k, (VALUES (0), (1)) s(side)) WHERE hl >= {min_child_weight} AND th - hl >= {min_child_weight})
       WHERE gain > 1e-6 QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, k, side) = 1)
  SELECT c.rid_, c.step + 1, CASE WHEN c.d = {depth} THEN 0 WHEN s.node IS NULL THEN c.node WHEN coalesce({value} <= s.k, s.side = 1) THEN 2 * c.node + 1 ELSE 2 * c.node + 2 END,
         CASE WHEN c.d = {depth} THEN c.m_ - {rate} * n.tg / (n.th + {l2}) ELSE c.m_ END
  FROM c LEFT JOIN n ON n.node = c.node LEFT JOIN s ON s.node = c.node)),
{p} AS MATERIALIZED (SELECT r.*, m_ FROM {p}_r r JOIN (SELECT rid_, m_ FROM {p}_s WHERE step = {trees * (depth + 1)}) USING (rid_))"""


def logistic_ctes(p: str, rows: str, steps: int = 12) -> str:
    """Newton steps of a weighted logistic regression with intercept on
    ``x1`` and ``x2`` of ``rows(y, w, x1, x2)``; the coefficients' squares
    (not the intercept's) are penalised by one half.  CTE ``<p>(b0, b1, b2)``."""
    out = [f"{p}_0 AS (SELECT 0.0::DOUBLE AS b0, 0.0::DOUBLE AS b1, 0.0::DOUBLE AS b2)"]
    det = lambda a, b, c: (f"({a[0]} * ({b[1]} * {c[2]} - {b[2]} * {c[1]}) - {a[1]} * ({b[0]} * {c[2]} - {b[2]} * {c[0]})"  # noqa: E731
                           f" + {a[2]} * ({b[0]} * {c[1]} - {b[1]} * {c[0]}))")
    h = [["h00", "h01", "h02"], ["h01", "h11", "h12"], ["h02", "h12", "h22"]]
    swap = lambda k: [[("g" + str(i)) if j == k else h[i][j] for j in range(3)] for i in range(3)]
    for s in range(steps):
        out.append(f"""{p}_g{s} AS MATERIALIZED (SELECT b0, b1, b2, sum(w * (y - q)) AS g0, sum(w * (y - q) * x1) - b1 AS g1, sum(w * (y - q) * x2) - b2 AS g2,
    sum(w * q * (1 - q)) AS h00, sum(w * q * (1 - q) * x1) AS h01, sum(w * q * (1 - q) * x2) AS h02, sum(w * q * (1 - q) * x1 * x1) + 1 AS h11,
    sum(w * q * (1 - q) * x1 * x2) AS h12, sum(w * q * (1 - q) * x2 * x2) + 1 AS h22
  FROM (SELECT y, w, x1, x2, b0, b1, b2, 1 / (1 + exp(-(b0 + b1 * x1 + b2 * x2))) AS q FROM {rows}, {p}_{s}) GROUP BY b0, b1, b2)""")
        out.append(f"{p}_{s + 1} AS MATERIALIZED (SELECT " + ", ".join(f"b{k} + {det(*swap(k))} / {det(*h)} AS b{k}" for k in range(3)) + f" FROM {p}_g{s})")
    return ",\n".join([*out, f"{p} AS (SELECT * FROM {p}_{steps})"])


def cox_ctes(p: str, rows: str, penalizer: float, steps: int = 10) -> str:
    """Newton steps of a Cox fit (Efron's ties) on ``x1`` and ``x2`` of
    ``rows(t, e, x1, x2)``.  CTE ``<p>(b1, b2, s1, s2)``: coefficients and
    standard errors at the optimum of mean log likelihood less half the
    penalizer times the squares."""
    out = [f"{p}_0 AS (SELECT 0.0::DOUBLE AS b1, 0.0::DOUBLE AS b2)"]
    sums = {"0": "1", "1": "x1", "2": "x2", "11": "x1 * x1", "12": "x1 * x2", "22": "x2 * x2"}
    for s in range(steps + 1):
        out.append(f"{p}_r{s} AS MATERIALIZED (SELECT t, sum(e) AS d, " + ", ".join(
            f"sum(th * {x}) AS s{k}, sum(e * th * {x}) AS e{k}" for k, x in sums.items()) + f""", sum(e * x1) AS xe1, sum(e * x2) AS xe2
  FROM (SELECT *, exp(b1 * x1 + b2 * x2) AS th FROM {rows}, {p}_{s}) GROUP BY t)""")
        out.append(f"{p}_a{s} AS MATERIALIZED (SELECT d, e0, e1, e2, e11, e12, e22, xe1, xe2, " + ", ".join(
            f"sum(s{k}) OVER (ORDER BY t DESC) AS a{k}" for k in sums) + f" FROM {p}_r{s})")
        out.append(f"{p}_c{s} AS MATERIALIZED (SELECT " + ", ".join(f"a{k} - c * e{k} AS u{k}" for k in sums)
                   + f" FROM (SELECT *, unnest(range(CAST(d AS BIGINT))) / d AS c FROM {p}_a{s} WHERE d > 0))")
        out.append(f"""{p}_g{s} AS MATERIALIZED (SELECT b1, b2, n, (x1 - m1) / n - {penalizer} * b1 AS g1, (x2 - m2) / n - {penalizer} * b2 AS g2,
    v11 / n + {penalizer} AS h11, v12 / n AS h12, v22 / n + {penalizer} AS h22
  FROM {p}_{s}, (SELECT count(*) AS n FROM {rows}), (SELECT sum(xe1) AS x1, sum(xe2) AS x2 FROM {p}_a{s}),
    (SELECT sum(u1 / u0) AS m1, sum(u2 / u0) AS m2, sum(u11 / u0 - u1 * u1 / u0 / u0) AS v11, sum(u12 / u0 - u1 * u2 / u0 / u0) AS v12,
            sum(u22 / u0 - u2 * u2 / u0 / u0) AS v22 FROM {p}_c{s}))""")
        out.append(f"""{p}_{s + 1} AS MATERIALIZED (SELECT b1 + (g1 * h22 - g2 * h12) / (h11 * h22 - h12 * h12) AS b1,
    b2 + (g2 * h11 - g1 * h12) / (h11 * h22 - h12 * h12) AS b2 FROM {p}_g{s})""")
    out.append(f"""{p} AS (SELECT b1, b2, sqrt(h22 / (h11 * h22 - h12 * h12) / n) AS s1, sqrt(h11 / (h11 * h22 - h12 * h12) / n) AS s2 FROM {p}_g{steps})""")
    return ",\n".join(out)


def isotonic_ctes(p: str, rows: str, score: str = "score", label: str = "label") -> str:
    """Isotonic regression by the max-min formula: the fit at a score is the
    largest, over starts at or before it, of the smallest mean, over ends at
    or after it.  CTE ``<p>(score, calibrated)``, a row per distinct score."""
    return f"""{p}_d AS MATERIALIZED (SELECT {score} AS score, row_number() OVER (ORDER BY {score}) AS i, count(*) AS n, sum({label}) AS s FROM {rows} GROUP BY {score}),
{p}_c AS MATERIALIZED (SELECT score, i, sum(n) OVER (ORDER BY i) AS cn, sum(s) OVER (ORDER BY i) AS cs FROM {p}_d),
{p}_p AS MATERIALIZED (SELECT a.i AS a, b.i AS b, (b.cs - coalesce(z.cs, 0))::DOUBLE / (b.cn - coalesce(z.cn, 0)) AS mean
  FROM {p}_c a JOIN {p}_c b ON b.i >= a.i LEFT JOIN {p}_c z ON z.i = a.i - 1),
{p}_m AS MATERIALIZED (SELECT a, b AS i, min(mean) OVER (PARTITION BY a ORDER BY b DESC) AS low FROM {p}_p),
{p} AS (SELECT score, calibrated FROM {p}_d JOIN (SELECT i, max(low) AS calibrated FROM {p}_m GROUP BY i) USING (i))"""


def auc_sql(rows: str, label: str = "label", score: str = "score") -> str:
    """A scalar subquery."""
    return f"""(SELECT sum(pos * (before + 0.5 * neg)) / (sum(pos) * sum(neg)) FROM (
  SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM (SELECT {score} AS s, sum({label})::DOUBLE AS pos, sum(1 - {label})::DOUBLE AS neg FROM {rows} GROUP BY {score})))"""


def pr_auc_sql(rows: str, label: str = "label", score: str = "score") -> str:
    """A scalar subquery."""
    return f"""(SELECT sum(pos * tp / (tp + fp)) / sum(pos) FROM (
  SELECT pos, sum(pos) OVER (ORDER BY s DESC ROWS UNBOUNDED PRECEDING) AS tp, sum(neg) OVER (ORDER BY s DESC ROWS UNBOUNDED PRECEDING) AS fp
  FROM (SELECT {score} AS s, sum({label})::DOUBLE AS pos, sum(1 - {label})::DOUBLE AS neg FROM {rows} GROUP BY {score})))"""
