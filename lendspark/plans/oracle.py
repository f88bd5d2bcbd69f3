"""Oracle SQL (DuckDB dialect) for the driver queries.

Each entry recomputes a registry query from the raw tables with the
fixture views inlined as CTEs. The SQL is written independently of the
Spark operators: AUC through average ranks, quantile bands through
``quantile_cont`` lists, PSI through explicit bin grids.
"""

from __future__ import annotations

from ..sources.fixtures import CONTINUOUS_SCORE, HALF_ZERO_SCORE, with_views_sql

D = 6
_SQL: dict[str, str] = {}


def sql(name: str, views: tuple[str, ...]):
    def deco(fn):
        _SQL[name] = with_views_sql(fn(), views)
        return fn

    return deco


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def plist(probs) -> str:
    return "[" + ", ".join(f"{p!r}::DOUBLE" for p in probs) + "]"


# The probability grids of ten quantile bands (with the percent
# round trip), of ten equal-width bins, and of the stability percentiles.
QCUT10 = plist([0.0, 0.1, 0.2, 0.30000000000000004, 0.4, 0.5, 0.6000000000000001, 0.7, 0.8, 0.9, 1.0])
WIDTH10 = [0.1, 0.2, 0.30000000000000004, 0.4, 0.5, 0.6000000000000001, 0.7000000000000001, 0.8, 0.9]
PCT10 = plist([0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0])


def band_expr(edges: str, v: str) -> str:
    return f"CAST(len(list_filter(list_slice({edges}, 2, len({edges}) - 1), lambda x: x < {v})) AS INTEGER)"


# ---------------------------------------------------------------- banding

BANDED = f"""banded AS (
  SELECT s.*, {band_expr('e.ep', 's.pd_hat')} AS pd_band
  FROM scored s, (SELECT list_sort(list_distinct(quantile_cont(pd_hat, {QCUT10}))) AS ep FROM scored) e
)"""

SUMMARY = """summary AS (
  SELECT pd_band AS band, min(pd_hat) AS pd_min, max(pd_hat) AS pd_max,
         avg(CAST("default" AS DOUBLE)) AS observed_default_rate, count(*) AS cnt,
         sum("default") AS positives
  FROM banded GROUP BY pd_band
)"""


@sql("band_assign", ("scored",))
def _():
    return f"""
SELECT row_id, {band_expr('e.ep', 's.pd_hat')} AS pd_band, {band_expr('e.et', 's.pd_tied')} AS tied_band
FROM scored s, (SELECT list_sort(list_distinct(quantile_cont(pd_hat, {QCUT10}))) AS ep,
                       list_sort(list_distinct(quantile_cont(pd_tied, {QCUT10}))) AS et FROM scored) e
"""


@sql("band_summary", ("scored",))
def _():
    return f"""WITH {BANDED}, {SUMMARY}
SELECT band, pd_min, pd_max, round(observed_default_rate, {D}) AS observed_default_rate,
       round(cnt / (SELECT sum(cnt) FROM summary), {D}) AS population_share, cnt AS "count"
FROM summary"""


@sql("band_metrics", ("scored",))
def _():
    return f"""WITH {BANDED}, {SUMMARY}
SELECT sum(cnt) AS total_observations,
       round(sum(positives) / sum(cnt), {D}) AS overall_default_rate,
       min(pd_min) AS pd_range_min, max(pd_max) AS pd_range_max,
       count(*) AS bands_created, round(avg(cnt), {D}) AS avg_band_size,
       round(avg(abs(observed_default_rate - (pd_min + pd_max) / 2)), {D}) AS calibration_gap
FROM summary"""


@sql("band_actions", ("scored",))
def _():
    labels = ("['Minimal Risk', 'Very Low Risk', 'Low Risk', 'Low-Medium Risk', 'Medium Risk', "
              "'Medium-High Risk', 'High Risk', 'Very High Risk', 'Critical Risk', 'Extreme Risk']")
    return f"""WITH {BANDED}, {SUMMARY}
SELECT band,
  {labels}[least(band, 9) + 1] AS risk_label,
  round(observed_default_rate - (pd_min + pd_max) / 2, {D}) AS calibration_diff,
  CASE WHEN abs(observed_default_rate - (pd_min + pd_max) / 2) < 0.02 THEN 'Well calibrated'
       WHEN observed_default_rate - (pd_min + pd_max) / 2 > 0 THEN 'Under-predicting risk'
       ELSE 'Over-predicting risk' END AS calibration,
  CASE WHEN observed_default_rate < 0.01 THEN '**Auto-approve** - Minimal risk, standard terms'
       WHEN observed_default_rate < 0.05 THEN '**Auto-approve** with monitoring - Low risk, consider favorable terms'
       WHEN observed_default_rate < 0.10 THEN '**Conditional approval** - Manual review for high-value cases'
       WHEN observed_default_rate < 0.20 THEN '**Manual review required** - Enhanced due diligence, risk-based pricing'
       WHEN observed_default_rate < 0.30 THEN '**Selective approval** - Decline unless strong mitigating factors'
       ELSE '**Auto-decline** - Unacceptable risk level' END AS action
FROM summary"""


# ---------------------------------------------------------------- metrics

def auc_rank_sql(src: str, p: str = "pd_hat", y: str = '"default"') -> str:
    """AUC by the rank-sum formula with average ranks for ties."""
    return f"""(SELECT (sum(CASE WHEN y = 1 THEN rk END) - P * (P + 1) / 2.0) / (P * N) AS auc
  FROM (SELECT y, avg_rank AS rk, sum(y) OVER () AS P, count(*) OVER () - sum(y) OVER () AS N
        FROM (SELECT {y} AS y, (rank() OVER (ORDER BY {p}) + count(*) OVER (PARTITION BY {p}) - 1 + rank() OVER (ORDER BY {p})) / 2.0 AS avg_rank
              FROM {src}) a) b
  GROUP BY P, N)"""


def ks_sql(src: str, p: str = "pd_hat", y: str = '"default"') -> str:
    return f"""(SELECT max(abs(cp / P - cn / N)) AS ks FROM (
  SELECT sum(pos) OVER (ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cp,
         sum(neg) OVER (ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cn,
         sum(pos) OVER () AS P, sum(neg) OVER () AS N
  FROM (SELECT {p} AS s, CAST(sum({y}) AS DOUBLE) AS pos, CAST(count(*) - sum({y}) AS DOUBLE) AS neg
        FROM {src} GROUP BY {p}) d) c)"""


CONF = """CASE WHEN sum(CASE WHEN pd_hat >= 0.5 THEN 1 ELSE 0 END) = 0 THEN 0.0 ELSE
    sum(CASE WHEN pd_hat >= 0.5 AND "default" = 1 THEN 1 ELSE 0 END) / sum(CASE WHEN pd_hat >= 0.5 THEN 1 ELSE 0 END) END"""
RECALL = """CASE WHEN sum("default") = 0 THEN 0.0 ELSE
    sum(CASE WHEN pd_hat >= 0.5 AND "default" = 1 THEN 1 ELSE 0 END) / sum("default") END"""
BRIER = """avg((pd_hat - "default") * (pd_hat - "default"))"""


@sql("metric_auc", ("scored",))
def _():
    return f"SELECT round(auc, {D}) AS auc FROM {auc_rank_sql('scored')} t"


@sql("metric_ks", ("scored",))
def _():
    return f"SELECT round(ks, {D}) AS ks FROM {ks_sql('scored')} t"


@sql("metric_confusion", ("scored",))
def _():
    return f"SELECT round({CONF}, {D}) AS precision, round({RECALL}, {D}) AS recall FROM scored"


@sql("metric_brier", ("scored",))
def _():
    return f"SELECT round({BRIER}, {D}) AS brier FROM scored"


@sql("metric_all", ("scored",))
def _():
    return f"""SELECT round(a.auc, {D}) AS auc, round(k.ks, {D}) AS ks, round(c.precision, {D}) AS precision,
       round(c.recall, {D}) AS recall, round(c.brier, {D}) AS brier
FROM {auc_rank_sql('scored')} a, {ks_sql('scored')} k,
     (SELECT {CONF} AS precision, {RECALL} AS recall, {BRIER} AS brier FROM scored) c"""


@sql("calibration_width", ("scored",))
def _():
    inner = ", ".join(f"{p!r}::DOUBLE" for p in WIDTH10)
    return f"""SELECT CAST(len(list_filter([{inner}], lambda e: e < pd_hat)) AS INTEGER) AS bin,
       round(avg(CAST("default" AS DOUBLE)), {D}) AS frac_pos, round(avg(pd_hat), {D}) AS mean_pred, count(*) AS n
FROM scored WHERE pd_hat IS NOT NULL GROUP BY 1"""


@sql("calibration_quantile", ("scored",))
def _():
    return f"""WITH {BANDED}
SELECT pd_band AS band, round(avg(pd_hat), {D}) AS mean_pred, round(avg(CAST("default" AS DOUBLE)), {D}) AS frac_pos,
       count(*) AS n
FROM banded GROUP BY pd_band"""


# ---------------------------------------------------------------- time split + PSI

SCORED_SPLIT = """scored_split AS (
  SELECT s.*, CASE WHEN CAST(epoch_us(issue_ts) AS DOUBLE) <= c.cut THEN 'train'
                   WHEN CAST(epoch_us(issue_ts) AS DOUBLE) > c.cut THEN 'validation' END AS split
  FROM scored s, (SELECT quantile_cont(CAST(epoch_us(issue_ts) AS DOUBLE), 0.8) AS cut FROM scored) c
)"""

LOANS_SPLIT = """loans_split AS (
  SELECT l.*, CASE WHEN CAST(epoch_us(issue_d) AS DOUBLE) <= c.cut THEN 'train'
                   WHEN CAST(epoch_us(issue_d) AS DOUBLE) > c.cut THEN 'validation' END AS split
  FROM loans l, (SELECT quantile_cont(CAST(epoch_us(issue_d) AS DOUBLE), 0.8) AS cut FROM loans) c
)"""


def psi_sql(exp_src: str, act_src: str, group: str | None = None, act_group: str | None = None) -> str:
    """PSI: edges from the expected side, left-closed bins (last closed),
    shares floored at 1e-8. ``group`` keys edges, ``act_group`` keys only
    the actual side. Returns a subquery with the keys and ``psi``."""
    g = f"{group}, " if group else ""
    gj = (lambda a, b: f"{a}.{group} = {b}.{group}") if group else (lambda a, b: "TRUE")
    ag = f"{act_group}, " if act_group else ""
    agj = (lambda a, b: f"{a}.{act_group} = {b}.{act_group}") if act_group else (lambda a, b: "TRUE")
    binx = ("CASE WHEN v < e[1] OR v > e[len(e)] THEN NULL WHEN v = e[len(e)] THEN len(e) - 2 "
            "ELSE len(list_filter(e, lambda x: x <= v)) - 1 END")
    keys_act = f"SELECT DISTINCT {g}{ag} 1 AS one FROM {act_src} WHERE v IS NOT NULL"
    keys = [k for k in (group, act_group) if k]
    part = ("PARTITION BY " + ", ".join(keys)) if keys else ""
    return f"""(
  WITH ed AS (SELECT {g} list_sort(list_distinct(quantile_cont(v, {PCT10}))) AS e
              FROM {exp_src} WHERE v IS NOT NULL {'GROUP BY ' + group if group else ''}),
  eb AS (SELECT {('x.' + group + ', ') if group else ''} {binx} AS b
         FROM {exp_src} x JOIN ed ON {gj('x', 'ed')} WHERE v IS NOT NULL),
  ab AS (SELECT {('x.' + group + ', ') if group else ''}{('x.' + act_group + ', ') if act_group else ''} {binx} AS b
         FROM {act_src} x JOIN ed ON {gj('x', 'ed')} WHERE v IS NOT NULL),
  ec AS (SELECT {g} b, count(*) AS c FROM eb WHERE b IS NOT NULL GROUP BY {g} b),
  ac AS (SELECT {g}{ag} b, count(*) AS c FROM ab WHERE b IS NOT NULL GROUP BY {g}{ag} b),
  keys AS ({keys_act}),
  grid AS (SELECT {('k.' + group + ', ') if group else ''}{('k.' + act_group + ', ') if act_group else ''} unnest(range(0, len(ed.e) - 1)) AS b
           FROM keys k JOIN ed ON {gj('k', 'ed')} WHERE len(ed.e) >= 2),
  cells AS (SELECT {('gr.' + group + ', ') if group else ''}{('gr.' + act_group + ', ') if act_group else ''}
                   CAST(coalesce(ec.c, 0) AS DOUBLE) AS ce, CAST(coalesce(ac.c, 0) AS DOUBLE) AS ca
            FROM grid gr
            LEFT JOIN ec ON gr.b = ec.b AND {gj('gr', 'ec')}
            LEFT JOIN ac ON gr.b = ac.b AND {gj('gr', 'ac')} AND {agj('gr', 'ac')}),
  shares AS (SELECT {g}{ag}
                    greatest(ce / (sum(ce) OVER ({part}) + 1e-8), 1e-8) AS es,
                    greatest(ca / (sum(ca) OVER ({part}) + 1e-8), 1e-8) AS as_
             FROM cells),
  res AS (SELECT {g}{ag} sum((as_ - es) * ln(as_ / es)) AS psi FROM shares GROUP BY ALL)
  SELECT k.*, res.psi FROM keys k LEFT JOIN res ON {gj('k', 'res')} AND {agj('k', 'res')}
)"""


@sql("psi_score", ("scored",))
def _():
    return f"""WITH {SCORED_SPLIT},
tr AS (SELECT pd_hat AS v FROM scored_split WHERE split = 'train'),
va AS (SELECT pd_hat AS v FROM scored_split WHERE split = 'validation')
SELECT round(psi, {D}) AS psi FROM {psi_sql('tr', 'va')} p"""


FEATURES = ["loan_amnt", "annual_inc", "dti", "fico_mean"]


def _unpivot(src: str, where: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{f}' AS feature, CAST({f} AS DOUBLE) AS v FROM {src} WHERE {where}" for f in FEATURES
    )


@sql("psi_features", ("loans",))
def _():
    return f"""WITH {LOANS_SPLIT},
tr AS ({_unpivot('loans_split', "split = 'train'")}),
va AS ({_unpivot('loans_split', "split = 'validation'")})
SELECT feature, round(psi, {D}) AS psi FROM {psi_sql('tr', 'va', group='feature')} p"""


@sql("psi_severity", ("loans",))
def _():
    return f"""WITH {LOANS_SPLIT},
tr AS ({_unpivot('loans_split', "split = 'train'")}),
va AS ({_unpivot('loans_split', "split = 'validation'")})
SELECT feature, round(psi, {D}) AS psi,
  CASE WHEN psi IS NULL THEN NULL WHEN psi < 0.1 THEN 'No significant change'
       WHEN psi <= 0.25 THEN 'Moderate change' ELSE 'Significant change' END AS severity
FROM {psi_sql('tr', 'va', group='feature')} p"""


# ---------------------------------------------------------------- period / segment

@sql("temporal_summary", ("scored",))
def _():
    return f"""SELECT coalesce(CAST(year(issue_ts) AS VARCHAR) || 'Q' || CAST(quarter(issue_ts) AS VARCHAR), 'NaT') AS period,
       round(avg(pd_hat), {D}) AS avg_pd, round(avg(CAST("default" AS DOUBLE)), {D}) AS obs_rate, count(*) AS n
FROM scored GROUP BY 1"""


@sql("temporal_summary_monthly", ("scored",))
def _():
    return f"""SELECT coalesce(strftime(issue_ts, '%Y-%m'), 'NaT') AS period,
       round(avg(pd_hat), {D}) AS avg_pd, round(avg(CAST("default" AS DOUBLE)), {D}) AS obs_rate, count(*) AS n
FROM scored GROUP BY 1"""


@sql("segment_performance", ("scored",))
def _():
    seg_auc = """(SELECT segment_col, segment,
          (sum(CASE WHEN y = 1 THEN rk END) - max(P) * (max(P) + 1) / 2.0) / (max(P) * max(N)) AS auc
   FROM (SELECT segment_col, segment, y,
                (rank() OVER (PARTITION BY segment_col, segment ORDER BY p) * 2
                 + count(*) OVER (PARTITION BY segment_col, segment, p) - 1) / 2.0 AS rk,
                sum(y) OVER (PARTITION BY segment_col, segment) AS P,
                count(*) OVER (PARTITION BY segment_col, segment) - sum(y) OVER (PARTITION BY segment_col, segment) AS N
         FROM long) a GROUP BY segment_col, segment)"""
    seg_ks = """(SELECT segment_col, segment, max(abs(cp / P - cn / N)) AS ks FROM (
     SELECT segment_col, segment,
       sum(pos) OVER (PARTITION BY segment_col, segment ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cp,
       sum(neg) OVER (PARTITION BY segment_col, segment ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cn,
       sum(pos) OVER (PARTITION BY segment_col, segment) AS P, sum(neg) OVER (PARTITION BY segment_col, segment) AS N
     FROM (SELECT segment_col, segment, p AS s, CAST(sum(y) AS DOUBLE) AS pos, CAST(count(*) - sum(y) AS DOUBLE) AS neg
           FROM long GROUP BY segment_col, segment, p) d) c GROUP BY segment_col, segment)"""
    return f"""WITH {BANDED},
long AS (
  SELECT 'pd_band' AS segment_col, CAST(pd_band AS VARCHAR) AS segment, pd_hat AS p, "default" AS y FROM banded
  UNION ALL SELECT 'term_months', CAST(term_months AS VARCHAR), pd_hat, "default" FROM banded
  UNION ALL SELECT 'grade', grade, pd_hat, "default" FROM banded
)
SELECT b.segment_col, b.segment, b.n, round(b.obs_rate, {D}) AS obs_rate, round(b.avg_pd, {D}) AS avg_pd,
       round(a.auc, {D}) AS auc, round(k.ks, {D}) AS ks, round(b.brier, {D}) AS brier
FROM (SELECT segment_col, segment, count(*) AS n, avg(CAST(y AS DOUBLE)) AS obs_rate, avg(p) AS avg_pd,
             avg((p - y) * (p - y)) AS brier FROM long WHERE segment IS NOT NULL GROUP BY 1, 2) b
JOIN {seg_auc} a USING (segment_col, segment)
JOIN {seg_ks} k USING (segment_col, segment)"""


@sql("approval", ("scored",))
def _():
    return f"""WITH {SCORED_SPLIT},
val AS (SELECT * FROM scored_split WHERE split = 'validation'),
tr AS (SELECT pd_hat AS v FROM scored_split WHERE split = 'train'),
va AS (SELECT pd_hat AS v FROM val),
m AS (SELECT a.auc, c.brier, p.psi FROM {auc_rank_sql('val')} a,
        (SELECT {BRIER} AS brier FROM val) c, {psi_sql('tr', 'va')} p),
iss AS (SELECT *, list_filter([
          CASE WHEN auc <> 0 AND auc < 0.65 THEN 'AUC below acceptable threshold (0.65)' END,
          CASE WHEN NOT isnan(psi) AND psi > 0.25 THEN 'Significant population drift detected (PSI > 0.25)' END,
          CASE WHEN brier <> 0 AND brier > 0.20 THEN 'Calibration concerns (high Brier score)' END],
          lambda x: x IS NOT NULL) AS l FROM m)
SELECT round(auc, {D}) AS auc, round(psi, {D}) AS psi, round(brier, {D}) AS brier,
       array_to_string(l, '; ') AS issues, CAST(len(l) AS INTEGER) AS n_issues,
       CASE WHEN len(l) = 0 THEN 'Approve with conditions' ELSE 'Conditional approval - address concerns' END AS decision
FROM iss"""


@sql("monitor_by_period", ("scored",))
def _():
    per_auc = """(SELECT period, (sum(CASE WHEN y = 1 THEN rk END) - max(P) * (max(P) + 1) / 2.0) / (max(P) * max(N)) AS auc
   FROM (SELECT period, y,
                (rank() OVER (PARTITION BY period ORDER BY p) * 2 + count(*) OVER (PARTITION BY period, p) - 1) / 2.0 AS rk,
                sum(y) OVER (PARTITION BY period) AS P,
                count(*) OVER (PARTITION BY period) - sum(y) OVER (PARTITION BY period) AS N
         FROM cur) a GROUP BY period HAVING max(P) > 0 AND max(N) > 0)"""
    return f"""WITH {SCORED_SPLIT},
cur AS (SELECT CAST(year(issue_ts) AS VARCHAR) || 'Q' || CAST(quarter(issue_ts) AS VARCHAR) AS period,
               pd_hat AS p, pd_hat AS v, "default" AS y FROM scored_split WHERE issue_ts IS NOT NULL),
tr AS (SELECT pd_hat AS v FROM scored_split WHERE split = 'train'),
base AS (SELECT period, count(*) AS n, avg((p - y) * (p - y)) AS brier FROM cur GROUP BY period)
SELECT b.period, b.n, round(ps.psi, {D}) AS psi, round(a.auc, {D}) AS auc, round(b.brier, {D}) AS brier,
       coalesce(ps.psi > 0.25, false) AS psi_trigger, coalesce(b.brier > 0.20, false) AS brier_trigger,
       coalesce(a.auc < 0.65, false) AS auc_trigger
FROM base b LEFT JOIN {per_auc} a USING (period)
LEFT JOIN {psi_sql('tr', 'cur', act_group='period')} ps USING (period)"""


# ---------------------------------------------------------------- splits

@sql("split_time", ("scored",))
def _():
    return f"WITH {SCORED_SPLIT} SELECT row_id, split FROM scored_split WHERE split IS NOT NULL"


@sql("split_counts", ("scored",))
def _():
    return f"WITH {SCORED_SPLIT} SELECT split, count(*) AS n FROM scored_split WHERE split IS NOT NULL GROUP BY split"


def quota_sql(src: str, n_draws: str) -> str:
    """Per-class quota (floor of the share, remainder to the largest
    fractional parts, ties to the smaller class)."""
    return f"""cc AS (SELECT y, count(*) AS c FROM {src} GROUP BY y),
tot AS (SELECT sum(c) AS n FROM cc),
drw AS (SELECT {n_draws} AS d FROM tot),
qq AS (SELECT y, c, c / n * d AS cont, floor(c / n * d) AS fl FROM cc, tot, drw),
need AS (SELECT (SELECT d FROM drw) - sum(fl) AS k FROM qq),
quota AS (SELECT y, fl + CASE WHEN row_number() OVER (ORDER BY cont - fl DESC, y) <= (SELECT k FROM need)
                              THEN 1 ELSE 0 END AS q FROM qq)"""


@sql("split_stratified", ("scored",))
def _():
    return f"""WITH base AS (SELECT row_id, "default" AS y FROM scored),
{quota_sql('base', 'n - ceil(0.2::DOUBLE * n)')},
ranked AS (SELECT row_id, y, row_number() OVER (PARTITION BY y ORDER BY row_id) AS rk FROM base)
SELECT row_id, CASE WHEN rk <= q THEN 'train' ELSE 'test' END AS split FROM ranked JOIN quota USING (y)"""


@sql("subsample", ("scored",))
def _():
    return f"""WITH base AS (SELECT row_id, "default" AS y FROM scored),
{quota_sql('base', 'greatest(2, round_even(n * 0.15::DOUBLE, 0))')},
ranked AS (SELECT row_id, y, row_number() OVER (PARTITION BY y ORDER BY row_id) AS rk FROM base)
SELECT row_id, y AS is_default FROM ranked JOIN quota USING (y) WHERE rk <= q"""


# ---------------------------------------------------------------- model fits


@sql("recalibrate", ("scored",))
def _():
    """Newton steps on the calibration counts, one table after the other."""
    steps = """s0 AS MATERIALIZED (
  SELECT 0.0::DOUBLE AS a, ln((n1 * hit + n0 * miss) / (n1 * (1 - hit) + n0 * (1 - miss))) AS b FROM goal)"""
    for i in range(12):
        steps += f""",
g{i} AS MATERIALIZED (
  SELECT any_value(s.a) AS a, any_value(s.b) AS b,
         sum(d * x) AS ga, sum(d) AS gb, sum(w * x * x) AS haa, sum(w * x) AS hab, sum(w) AS hbb
  FROM (SELECT x, s.a, s.b, m * p - wanted AS d, m * p * (1 - p) AS w
        FROM (SELECT c.*, 1 / (1 + exp(-(s.a * x + s.b))) AS p, s.a, s.b FROM points c, s{i} s) s) s),
s{i + 1} AS MATERIALIZED (
  SELECT a - (hbb * ga - hab * gb) / (haa * hbb - hab * hab) AS a, b - (haa * gb - hab * ga) / (haa * hbb - hab * hab) AS b FROM g{i})"""
    return f"""WITH base AS (SELECT row_id, "default" AS y FROM scored),
{quota_sql('base', 'n - ceil(0.8::DOUBLE * n)')},
ranked AS (SELECT s.row_id, s.pd_hat AS x, s."default" AS y, row_number() OVER (PARTITION BY s."default" ORDER BY s.row_id) AS rk FROM scored s),
cal AS MATERIALIZED (SELECT x, y FROM ranked JOIN quota USING (y) WHERE rk <= q),
goal AS MATERIALIZED (
  SELECT n1, n0, (n1 + 1) / (n1 + 2) AS hit, 1 / (n0 + 2) AS miss
  FROM (SELECT count(*) FILTER (y = 1)::DOUBLE AS n1, count(*) FILTER (y = 0)::DOUBLE AS n0 FROM cal)),
points AS MATERIALIZED (
  SELECT x, count(*)::DOUBLE AS m, sum(CASE WHEN y = 1 THEN hit ELSE miss END) AS wanted FROM cal, goal GROUP BY x),
{steps}
SELECT s.row_id, s.pd_hat, round(1 / (1 + exp(-(f.a * s.pd_hat + f.b))), {D}) AS pd_hat_recal FROM scored s, s12 f"""


def newton_sql(train: str) -> str:
    """Newton steps of a balanced L2 model (C = 1) on loan_amnt and dti of
    ``train``, three unknowns by Cramer's rule; the last table is ``s12``."""
    det = lambda m: " + ".join(
        f"{m[0][i]} * ({m[1][(i + 1) % 3]} * {m[2][(i + 2) % 3]} - {m[1][(i + 2) % 3]} * {m[2][(i + 1) % 3]})" for i in range(3)
    )
    h = [["h00", "h01", "h02"], ["h01", "h11", "h12"], ["h02", "h12", "h22"]]
    swap = lambda k: [[f"g{r}" if c == k else h[r][c] for c in range(3)] for r in range(3)]
    steps = "s0 AS MATERIALIZED (SELECT 0.0::DOUBLE AS b0, 0.0::DOUBLE AS b1, 0.0::DOUBLE AS b2)"
    for i in range(12):
        steps += f""",
d{i} AS MATERIALIZED (
  SELECT b0, b1, b2, sum(r) AS g0, sum(r * x1) + b1 AS g1, sum(r * x2) + b2 AS g2, sum(w) AS h00, sum(w * x1) AS h01, sum(w * x2) AS h02,
         sum(w * x1 * x1) + 1 AS h11, sum(w * x1 * x2) AS h12, sum(w * x2 * x2) + 1 AS h22
  FROM (SELECT x1, x2, b0, b1, b2, k * (p - y) AS r, k * p * (1 - p) AS w
        FROM (SELECT z.*, s.*, 1 / (1 + exp(-(b0 + b1 * x1 + b2 * x2))) AS p FROM scaled z, s{i} s))
  GROUP BY b0, b1, b2),
s{i + 1} AS MATERIALIZED (
  SELECT b0 - ({det(swap(0))}) / ({det(h)}) AS b0, b1 - ({det(swap(1))}) / ({det(h)}) AS b1, b2 - ({det(swap(2))}) / ({det(h)}) AS b2 FROM d{i})"""
    return f"""scaled AS MATERIALIZED (
  SELECT "default"::DOUBLE AS y,
         (loan_amnt - avg(loan_amnt) OVER ()) / stddev_pop(loan_amnt) OVER () AS x1, (dti - avg(dti) OVER ()) / stddev_pop(dti) OVER () AS x2,
         count(*) OVER () / (2.0 * count(*) OVER (PARTITION BY "default")) AS k
  FROM {train}),
{steps}"""


@sql("train_logistic", ("scored",))
def _():
    return f"""WITH {newton_sql('scored')}
SELECT 'intercept' AS feature, round(b0, {D}) AS coefficient FROM s12
UNION ALL SELECT 'loan_amnt', round(b1, {D}) FROM s12
UNION ALL SELECT 'dti', round(b2, {D}) FROM s12"""


_SQL["io_model"] = _SQL["train_logistic"]


@sql("performance_report", ("scored",))
def _():
    """Fit on the training period, metrics on the rest."""
    return f"""WITH {SCORED_SPLIT},
tr AS MATERIALIZED (SELECT * FROM scored_split WHERE split = 'train'),
{newton_sql('tr')},
va AS MATERIALIZED (
  SELECT 1 / (1 + exp(-(b0 + b1 * (v.loan_amnt - m.a1) / m.d1 + b2 * (v.dti - m.a2) / m.d2))) AS pd_hat, v."default"
  FROM (SELECT * FROM scored_split WHERE split = 'validation') v, s12,
       (SELECT avg(loan_amnt) AS a1, stddev_pop(loan_amnt) AS d1, avg(dti) AS a2, stddev_pop(dti) AS d2 FROM tr) m),
found AS (
  SELECT a.auc, k.ks, c.* FROM {auc_rank_sql('va')} a, {ks_sql('va')} k,
         (SELECT {CONF} AS precision, {RECALL} AS recall, {BRIER} AS brier FROM va) c)
SELECT section, metric, round(value, {D}) AS value FROM (
  SELECT 'summary' AS section, 'training_rows' AS metric, count(*)::DOUBLE AS value FROM tr
  UNION ALL SELECT 'summary', 'validation_rows', count(*) FROM va
  UNION ALL SELECT 'tuning', 'best_c', NULL
  UNION ALL SELECT 'baseline', 'auc', auc FROM found UNION ALL SELECT 'baseline', 'ks', ks FROM found
  UNION ALL SELECT 'baseline', 'precision', precision FROM found UNION ALL SELECT 'baseline', 'recall', recall FROM found
  UNION ALL SELECT 'baseline', 'brier', brier FROM found
  UNION ALL SELECT 'selection', 'baseline_auc', auc FROM found UNION ALL SELECT 'selection', 'tuned_auc', NULL
  UNION ALL SELECT 'selection', 'delta', NULL UNION ALL SELECT 'selection', 'tuned_selected', NULL)"""


@sql("calibrate_report", ("scored",))
def _():
    return f"""WITH recal AS MATERIALIZED (SELECT * FROM ({_SQL['recalibrate']})),
recal_y AS (SELECT r.pd_hat_recal AS p, s."default" AS y FROM recal r JOIN scored s USING (row_id))
SELECT 'calibration' AS section, band::VARCHAR AS key, unnest(['mean_pred', 'frac_pos', 'n']) AS metric,
       unnest([mean_pred, frac_pos, n::DOUBLE]) AS value FROM ({_SQL['calibration_quantile']})
UNION ALL SELECT 'brier', '', 'brier', brier FROM ({_SQL['metric_brier']})
UNION ALL SELECT 'recalibrated', '', 'brier', round(avg((p - y) * (p - y)), {D}) FROM recal_y
UNION ALL SELECT 'recalibrated', '', 'avg_pd', round(avg(p), {D}) FROM recal_y"""


@sql("validate_report", ("scored",))
def _():
    """Each table on its own, from the rows of the validation period."""
    segment = f"""SELECT seg, n, obs_rate, avg_pd, brier, ks, (s1 - P * (P + 1) / 2.0) / (P * N0) AS auc FROM (
  SELECT seg, count(*) AS n, avg(y) AS obs_rate, avg(p) AS avg_pd, avg((p - y) * (p - y)) AS brier, sum(y) AS P, count(*) - sum(y) AS N0,
         sum(CASE WHEN y = 1 THEN rk END) AS s1
  FROM (SELECT *, rank() OVER (PARTITION BY seg ORDER BY p) + (count(*) OVER (PARTITION BY seg, p) - 1) / 2.0 AS rk FROM long) GROUP BY seg)
JOIN (SELECT seg, max(abs(cp / P - cn / N0)) AS ks FROM (
  SELECT seg, sum(y) OVER w AS cp, sum(1 - y) OVER w AS cn, sum(y) OVER (PARTITION BY seg) AS P, sum(1 - y) OVER (PARTITION BY seg) AS N0
  FROM long WINDOW w AS (PARTITION BY seg ORDER BY p DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) GROUP BY seg) USING (seg)"""
    side = lambda s: " UNION ALL ".join(
        f"SELECT '{f}' AS feature, CAST({f} AS DOUBLE) AS v FROM scored_split WHERE split = '{s}'" for f in ("loan_amnt", "dti"))
    return f"""WITH {SCORED_SPLIT},
val AS MATERIALIZED (SELECT * FROM scored_split WHERE split = 'validation'),
tr AS (SELECT pd_hat AS v FROM scored_split WHERE split = 'train'), va AS (SELECT pd_hat AS v FROM val),
ftr AS ({side('train')}), fva AS ({side('validation')}),
long AS MATERIALIZED (
  SELECT 'term_months=' || term_months::VARCHAR AS seg, pd_hat AS p, "default"::DOUBLE AS y FROM val WHERE term_months IS NOT NULL
  UNION ALL SELECT 'grade=' || grade, pd_hat, "default" FROM val WHERE grade IS NOT NULL),
one AS MATERIALIZED (SELECT a.auc, k.ks, b.brier, p.psi FROM {auc_rank_sql('val')} a, {ks_sql('val')} k,
  (SELECT {BRIER} AS brier FROM val) b, {psi_sql('tr', 'va')} p),
rows AS (
  SELECT 'out_of_time' AS section, '' AS key, unnest(['auc', 'ks', 'brier']) AS metric, unnest([auc, ks, brier]) AS value FROM one
  UNION ALL SELECT 'psi', '', 'psi', psi FROM one
  UNION ALL SELECT 'feature_psi', '', feature, psi FROM {psi_sql('ftr', 'fva', group='feature')} f
  UNION ALL SELECT 'approval', '', 'n_issues', (auc < 0.65)::INT + (psi > 0.25)::INT + (brier > 0.20)::INT FROM one
  UNION ALL SELECT 'by_period', period, unnest(['avg_pd', 'obs_rate', 'n']), unnest([avg_pd, obs_rate, n::DOUBLE]) FROM (
    SELECT coalesce(CAST(year(issue_ts) AS VARCHAR) || 'Q' || CAST(quarter(issue_ts) AS VARCHAR), 'NaT') AS period, avg(pd_hat) AS avg_pd,
           avg("default"::DOUBLE) AS obs_rate, count(*) AS n FROM val GROUP BY 1)
  UNION ALL SELECT 'by_segment', seg, unnest(['n', 'obs_rate', 'avg_pd', 'auc', 'ks', 'brier']), unnest([n::DOUBLE, obs_rate, avg_pd, auc, ks, brier]) FROM ({segment}))
SELECT section, key, metric, round(value, {D}) AS value FROM rows"""


_SQL["monitor_state"] = _SQL["monitor_by_period"]


@sql("io_round_trip", ("loans_raw",))
def _():
    text = ", ".join(f"CASE WHEN {c} NOT IN ('', 'n/a') THEN {c} END AS {c}"
                     for c in ("loan_status", "int_rate", "term", "emp_length", "issue_d", "home_ownership", "emp_title"))
    return f"""SELECT row_id, {text}, 'say "it",' || chr(10) || 'row ' || row_id::VARCHAR AS note, fico_range_low::BIGINT AS fico_range_low,
       round(loan_amnt, {D}) AS loan_amnt, round(annual_inc, {D}) AS annual_inc, round(dti, {D}) AS dti FROM loans_raw"""


# ---------------------------------------------------------------- cleaning

RAW_COLS = ['row_id', 'loan_status', 'loan_amnt', 'annual_inc', 'int_rate', 'revol_util', 'term', 'emp_length',
            'issue_d', 'earliest_cr_line', 'fico_range_low', 'fico_range_high', 'dti', 'revol_bal', 'installment',
            'home_ownership', 'purpose', 'addr_state', 'emp_title', 'grade', 'mths_since_last_record', 'total_pymnt']
RENAMED = {"revol_util": "revol_util_pct", "emp_title": "emptitle", "addr_state": "addr_state2"}


def cols(exclude=(), src_prefix: str = "") -> str:
    return ", ".join(f"{src_prefix}{c}" for c in RAW_COLS if c not in exclude)


@sql("clean_names", ("loans_raw",))
def _():
    return "SELECT " + ", ".join(f"{c} AS {RENAMED.get(c, c)}" for c in RAW_COLS) + " FROM loans_raw"


@sql("drop_irrelevant", ("loans_raw",))
def _():
    return f"SELECT {cols(exclude=('total_pymnt',))} FROM loans_raw"


@sql("clean_percent", ("loans",))
def _():
    return "SELECT row_id, int_rate, revol_util FROM loans"


@sql("clean_term", ("loans",))
def _():
    return "SELECT row_id, term, term_months FROM loans"


@sql("clean_emp_length", ("loans",))
def _():
    return "SELECT row_id, emp_length, emp_length_int FROM loans"


@sql("clean_dates", ("loans",))
def _():
    return ("SELECT row_id, strftime(issue_d, '%Y-%m-%d') AS issue_d, "
            "strftime(earliest_cr_line, '%Y-%m-%d') AS earliest_cr_line FROM loans")


@sql("clean_fico", ("loans",))
def _():
    return "SELECT row_id, fico_mean, loan_amnt, annual_inc, dti, revol_bal FROM loans"


@sql("missing_profile", ("loans_raw",))
def _():
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", round(avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END), {D}) AS missing_rate "
        f"FROM loans_raw" for c in RAW_COLS
    )


@sql("drop_sparse", ("loans_raw",))
def _():
    return f"SELECT {cols(exclude=('mths_since_last_record',))} FROM loans_raw"


FILTERED = """filtered AS (
  SELECT * EXCLUDE (mths_since_last_record) FROM loans
  WHERE loan_status IS NOT NULL AND loan_amnt IS NOT NULL AND int_rate IS NOT NULL AND annual_inc IS NOT NULL
)"""

IMPUTED_SELECT = """SELECT row_id, loan_status, loan_amnt, annual_inc, int_rate, revol_util,
  coalesce(term, 'Unknown') AS term, coalesce(emp_length, 'Unknown') AS emp_length,
  strftime(issue_d, '%Y-%m-%d') AS issue_d, strftime(earliest_cr_line, '%Y-%m-%d') AS earliest_cr_line,
  fico_range_low, fico_range_high, coalesce(dti, m.md) AS dti, revol_bal, installment,
  coalesce(home_ownership, 'Unknown') AS home_ownership, coalesce(purpose, 'Unknown') AS purpose,
  coalesce(addr_state, 'Unknown') AS addr_state, coalesce(emp_title, 'Unknown') AS emp_title,
  coalesce(grade, 'Unknown') AS grade, {extra}
  coalesce(term_months, m.mt) AS term_months, coalesce(emp_length_int, m.me) AS emp_length_int, fico_mean,
  CAST(dti IS NULL AS INTEGER) AS dti_missing, CAST(term_months IS NULL AS INTEGER) AS term_months_missing,
  CAST(emp_length_int IS NULL AS INTEGER) AS emp_length_int_missing
FROM filtered, (SELECT median(dti) AS md, median(term_months) AS mt, median(emp_length_int) AS me FROM filtered) m"""


@sql("drop_missing_rows", ("loans",))
def _():
    return ("SELECT row_id, loan_status, loan_amnt, int_rate, annual_inc FROM loans WHERE loan_status IS NOT NULL "
            "AND loan_amnt IS NOT NULL AND int_rate IS NOT NULL AND annual_inc IS NOT NULL")


@sql("impute_clean", ("loans",))
def _():
    return f"WITH {FILTERED}\n" + IMPUTED_SELECT.format(extra="total_pymnt,")


@sql("clean_pipeline", ("loans",))
def _():
    return f"WITH {FILTERED}\n" + IMPUTED_SELECT.format(extra="")


# ---------------------------------------------------------------- targets

T1 = ("CASE WHEN lower(loan_status) LIKE '%charg%' OR lower(loan_status) LIKE '%default%' THEN 1 ELSE 0 END")
T2 = ("CASE WHEN lower(coalesce(loan_status, 'nan')) LIKE '%paid%' THEN 0 "
      "WHEN lower(coalesce(loan_status, 'nan')) LIKE '%charg%' OR lower(coalesce(loan_status, 'nan')) LIKE '%default%' "
      "THEN 1 END")


@sql("target_simple", ("loans_raw",))
def _():
    return f"SELECT row_id, loan_status, CAST({T1} AS INTEGER) AS is_default FROM loans_raw"


@sql("target_conservative", ("loans_raw",))
def _():
    return f"SELECT row_id, loan_status, CAST({T2} AS INTEGER) AS is_default FROM loans_raw WHERE ({T2}) IS NOT NULL"


@sql("target_report", ("loans_raw",))
def _():
    return f"SELECT count({T2}) AS kept, sum(CASE WHEN ({T2}) IS NULL THEN 1 ELSE 0 END) AS dropped FROM loans_raw"


@sql("target_ensure", ("loans_raw",))
def _():
    txt = ("CASE WHEN loan_status IS NULL THEN NULL WHEN loan_status = 'Default' THEN '1' "
           "WHEN loan_status = 'Charged Off' THEN '0.7' WHEN loan_status = 'Current' THEN 'unknown' ELSE '0' END")
    return f"SELECT row_id, CAST(trunc(coalesce(TRY_CAST({txt} AS DOUBLE), 0.0)) AS INTEGER) AS is_default FROM loans_raw"


@sql("target_ensure_derived", ("loans_raw",))
def _():
    return f"SELECT row_id, CAST({T1} AS INTEGER) AS is_default FROM loans_raw"


@sql("drop_leakage", ("loans_raw",))
def _():
    return f"SELECT {cols(exclude=('total_pymnt',))} FROM loans_raw"


# ---------------------------------------------------------------- features

F4 = """CAST(CASE WHEN emp_length IS NULL OR trim(emp_length) IN ('n/a', 'nan', 'None', '') THEN NULL
     WHEN contains(trim(emp_length), '+') THEN CAST(trim(replace(replace(trim(emp_length), '+ years', ''), '+ year', '')) AS INTEGER)
     WHEN contains(trim(emp_length), '<') THEN 0
     WHEN regexp_matches(split_part(trim(emp_length), ' ', 1), '^[+-]?[0-9]+$') THEN CAST(split_part(trim(emp_length), ' ', 1) AS BIGINT)
     END AS DOUBLE)"""


def label_bin_sql(x: str, edges, labels) -> str:
    parts = [f"WHEN {x} >= {edges[0]} AND {x} <= {edges[1]} THEN '{labels[0]}'"]
    for lo, hi, lab in zip(edges[1:-1], edges[2:], labels[1:]):
        parts.append(f"WHEN {x} > {lo} AND {x} <= {hi} THEN '{lab}'")
    return "CASE " + " ".join(parts) + " ELSE 'missing' END"


EMP_BIN = label_bin_sql(f"coalesce({F4}, -1.0)", [-0.1, 2, 5, 9, 100], ["0-2", "3-5", "6-9", "10+"])
RATE_BIN = label_bin_sql("coalesce(int_rate, -1.0)", [0, 8, 12, 16, 20, 100], ["<8", "8-12", "12-16", "16-20", ">=20"])
HISTORY = "floor((epoch_us(issue_d) - epoch_us(earliest_cr_line)) / 86400000000.0) / 365.25"
TERM_LONG = "CAST(coalesce(term_months > 36, false) AS DOUBLE)"
LOGS = ["annual_inc", "loan_amnt", "revol_bal", "installment"]


@sql("feat_ratio", ("loans",))
def _():
    return "SELECT row_id, int_rate, dti AS dti_ratio, loan_amnt / nullif(annual_inc, 0) AS lti FROM loans"


@sql("feat_emp_bin", ("loans",))
def _():
    return f"SELECT row_id, emp_length, {F4} AS emp_length_num, {EMP_BIN} AS emp_length_bin FROM loans"


@sql("feat_rate_bin", ("loans",))
def _():
    return f"SELECT row_id, int_rate, {RATE_BIN} AS int_rate_bin FROM loans"


@sql("feat_history", ("loans",))
def _():
    return f"SELECT row_id, {HISTORY} AS credit_history_years FROM loans"


@sql("feat_term", ("loans",))
def _():
    return f"SELECT row_id, term_months, {TERM_LONG} AS term_long FROM loans"


@sql("feat_interaction", ("loans",))
def _():
    return (f"SELECT row_id, round(loan_amnt * coalesce(int_rate, m.md), {D}) AS loan_x_int "
            "FROM loans, (SELECT median(int_rate) AS md FROM loans) m")


@sql("feat_log", ("loans",))
def _():
    return "SELECT row_id, " + ", ".join(
        f"round(CASE WHEN {c} IS NOT NULL THEN ln(1 + greatest({c}, 0.0)) END, {D}) AS {c}_log1p" for c in LOGS
    ) + " FROM loans"


FREQ = ["emp_title", "emp_length", "addr_state"]


@sql("enc_frequency", ("loans",))
def _():
    return "SELECT row_id, " + ", ".join(
        f"CAST(count(*) OVER (PARTITION BY coalesce({c}, 'missing')) AS DOUBLE) AS {c}_freq_enc" for c in FREQ
    ) + " FROM loans"


ONEHOT = {
    "home_ownership": ["MORTGAGE", "OWN", "RENT"],
    "purpose": ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"],
    "int_rate_bin": ["<8", "8-12", "12-16", "16-20", ">=20", "missing"],
    "emp_length_bin": ["0-2", "3-5", "6-9", "10+", "missing"],
}


def onehot_sql() -> str:
    parts = []
    for c, lv in ONEHOT.items():
        for x in lv[1:]:
            parts.append(f"CAST(coalesce({c} = '{x}', false) AS INTEGER) AS \"{c}_{x}\"")
        parts.append(f"CAST({c} IS NULL AS INTEGER) AS \"{c}_nan\"")
    return ", ".join(parts)


@sql("enc_onehot", ("loans",))
def _():
    return (f"SELECT row_id, {onehot_sql()} FROM (SELECT row_id, home_ownership, purpose, "
            f"{RATE_BIN} AS int_rate_bin, {EMP_BIN} AS emp_length_bin FROM loans) x")


TE_SQL = f"""te AS (
  WITH b AS (SELECT row_id, coalesce(emp_title, 'missing') AS v, CAST({T1} AS DOUBLE) AS y, row_id % 5 AS f FROM loans),
  vf AS (SELECT v, f, sum(y) AS s, count(*) AS n FROM b GROUP BY v, f),
  vt AS (SELECT v, sum(y) AS s_all, count(*) AS n_all FROM b GROUP BY v),
  g AS (SELECT avg(y) AS gm FROM b)
  SELECT b.row_id, coalesce(CASE WHEN vt.n_all - vf.n > 0 THEN (vt.s_all - vf.s) / (vt.n_all - vf.n) END, g.gm) AS te
  FROM b JOIN vt USING (v) JOIN vf USING (v, f), g
)"""


@sql("enc_target_kfold", ("loans",))
def _():
    return f"WITH {TE_SQL} SELECT row_id, round(te, {D}) AS emp_title_target_te FROM te"


NUM_LOANS = ["loan_amnt", "annual_inc", "int_rate", "revol_util", "fico_range_low", "fico_range_high", "dti",
             "revol_bal", "installment", "mths_since_last_record", "total_pymnt", "term_months", "emp_length_int",
             "fico_mean"]
FLAGGED = ["emp_length", "home_ownership", "emp_title", "mths_since_last_record", "emp_length_int"]


@sql("impute_clip", ("loans",))
def _():
    med = ", ".join(f"median({c}) AS m_{c}" for c in NUM_LOANS)
    filled = ", ".join(f"coalesce(CAST({c} AS DOUBLE), m.m_{c}) AS {c}" for c in NUM_LOANS)
    qs = ", ".join(f"quantile_cont({c}, 0.01) AS lo_{c}, quantile_cont({c}, 0.99) AS hi_{c}" for c in NUM_LOANS)
    clipped = ", ".join(f"least(greatest({c}, q.lo_{c}), q.hi_{c}) AS {c}" for c in NUM_LOANS)
    flags = ", ".join(f"CAST({c} IS NULL AS INTEGER) AS {c}_missing" for c in FLAGGED)
    return f"""WITH m AS (SELECT {med} FROM loans),
filled AS (SELECT row_id, {filled}, {flags} FROM loans, m),
q AS (SELECT {qs} FROM filled),
clipped AS (SELECT row_id, {clipped}, {", ".join(f"{c}_missing" for c in FLAGGED)} FROM filled, q)
SELECT row_id, {", ".join(f"round({c}, {D}) AS {c}" for c in NUM_LOANS)},
       {", ".join(f"{c}_missing" for c in FLAGGED)},
       {", ".join(f"round(ln(1 + greatest({c}, 0.0)), {D}) AS {c}_log1p" for c in LOGS)}
FROM clipped"""


SCALE = ["loan_amnt", "annual_inc", "dti", "fico_mean", "revol_bal", "installment"]


@sql("scale", ("loans",))
def _():
    st = ", ".join(f"avg({c}) AS a_{c}, stddev_pop({c}) AS s_{c}" for c in SCALE)
    sc = ", ".join(
        f"round((CAST({c} AS DOUBLE) - st.a_{c}) / CASE WHEN st.s_{c} IS NULL OR st.s_{c} = 0 THEN 1.0 ELSE st.s_{c} END, {D}) AS {c}"
        for c in SCALE)
    return f"""WITH {LOANS_SPLIT},
st AS (SELECT {st} FROM loans_split WHERE split = 'train')
SELECT row_id, {sc} FROM loans_split, st"""


# ---------------------------------------------------------------- joins

@sql("join_labels", ("loans_raw", "scored"))
def _():
    return f"""SELECT s.row_id, s.loan_amnt, l.t AS is_default FROM scored s
LEFT JOIN (SELECT row_id, CAST({T2} AS INTEGER) AS t FROM loans_raw WHERE ({T2}) IS NOT NULL) l USING (row_id)"""


@sql("recover_time", ("loans", "scored"))
def _():
    return """SELECT s.row_id, s.pd_hat, strftime(l.issue_d, '%Y-%m-%d') AS issue_d
FROM scored s LEFT JOIN loans l USING (row_id)"""


# ---------------------------------------------------------------- reports

LOANS_COLS = RAW_COLS[:4] + ["int_rate", "revol_util"] + RAW_COLS[6:] + ["term_months", "emp_length_int", "fico_mean"]
LOANS_COLS = list(dict.fromkeys(LOANS_COLS)) + ["default"]
NUMERIC_LOANS = 16


@sql("feature_summary", ("loans",))
def _():
    base = f'base AS (SELECT *, CAST({T1} AS INTEGER) AS "default" FROM loans)'
    miss = " UNION ALL ".join(
        f"SELECT '{c}' AS metric, avg(CASE WHEN \"{c}\" IS NULL THEN 1.0 ELSE 0.0 END) AS value FROM base"
        for c in LOANS_COLS)
    return f"""WITH {base},
miss AS ({miss}),
top AS (SELECT metric, value FROM miss ORDER BY value DESC, metric ASC LIMIT 10)
SELECT 'shape' AS section, 'rows' AS metric, round(CAST(count(*) AS DOUBLE), {D}) AS value FROM base
UNION ALL SELECT 'shape', 'columns', {float(len(LOANS_COLS))}
UNION ALL SELECT 'shape', 'numeric_features', {float(NUMERIC_LOANS)}
UNION ALL SELECT 'missing', metric, round(value, {D}) FROM top
UNION ALL SELECT 'target', CAST("default" AS VARCHAR), round(CAST(count(*) AS DOUBLE), {D}) FROM base GROUP BY "default"
"""


@sql("band_report", ("scored",))
def _():
    return f"""WITH {BANDED}, {SUMMARY}
SELECT band, pd_min, pd_max, round(observed_default_rate, {D}) AS observed_default_rate,
  round(cnt / (SELECT sum(cnt) FROM summary), {D}) AS population_share, cnt AS "count",
  ['Minimal Risk', 'Very Low Risk', 'Low Risk', 'Low-Medium Risk', 'Medium Risk', 'Medium-High Risk', 'High Risk',
   'Very High Risk', 'Critical Risk', 'Extreme Risk'][least(band, 9) + 1] AS risk_label,
  CASE WHEN abs(observed_default_rate - (pd_min + pd_max) / 2) < 0.02 THEN 'Well calibrated'
       WHEN observed_default_rate - (pd_min + pd_max) / 2 > 0 THEN 'Under-predicting risk'
       ELSE 'Over-predicting risk' END AS calibration,
  CASE WHEN observed_default_rate < 0.01 THEN '**Auto-approve** - Minimal risk, standard terms'
       WHEN observed_default_rate < 0.05 THEN '**Auto-approve** with monitoring - Low risk, consider favorable terms'
       WHEN observed_default_rate < 0.10 THEN '**Conditional approval** - Manual review for high-value cases'
       WHEN observed_default_rate < 0.20 THEN '**Manual review required** - Enhanced due diligence, risk-based pricing'
       WHEN observed_default_rate < 0.30 THEN '**Selective approval** - Decline unless strong mitigating factors'
       ELSE '**Auto-decline** - Unacceptable risk level' END AS action
FROM summary"""


# ---------------------------------------------------------------- model-ready table (PL2)

def _model_ready_sql(route: str = "conservative") -> str:
    """PL2 (``conservative``: T2 target) or PL1 (``split``: T1 target, then a
    stratified split ordered by ``row_id`` and a scaler fitted on train)."""
    term_m = "CAST(nullif(regexp_extract(term, '([0-9]+)', 1), '') AS DOUBLE)"
    cleaned = """cleaned AS (
  SELECT row_id, loan_status, loan_amnt, annual_inc, int_rate, revol_util,
    coalesce(term, 'Unknown') AS term, coalesce(emp_length, 'Unknown') AS emp_length, issue_d, earliest_cr_line,
    fico_range_low, fico_range_high, coalesce(dti, m.md) AS dti, revol_bal, installment,
    coalesce(home_ownership, 'Unknown') AS home_ownership, coalesce(purpose, 'Unknown') AS purpose,
    coalesce(addr_state, 'Unknown') AS addr_state, coalesce(emp_title, 'Unknown') AS emp_title,
    coalesce(grade, 'Unknown') AS grade,
    coalesce(term_months, m.mt) AS term_months, coalesce(emp_length_int, m.me) AS emp_length_int, fico_mean,
    CAST(dti IS NULL AS INTEGER) AS dti_missing, CAST(term_months IS NULL AS INTEGER) AS term_months_missing,
    CAST(emp_length_int IS NULL AS INTEGER) AS emp_length_int_missing
  FROM filtered, (SELECT median(dti) AS md, median(term_months) AS mt, median(emp_length_int) AS me FROM filtered) m
)"""
    if route == "conservative":
        t2 = f"""t2 AS (SELECT *, CAST({T2} AS INTEGER) AS "default" FROM cleaned WHERE ({T2}) IS NOT NULL)"""
    else:
        t2 = f"""t2 AS (SELECT *, CAST({T1} AS INTEGER) AS "default" FROM cleaned)"""
    freq = ", ".join(
        f"CAST(count(*) OVER (PARTITION BY coalesce({c}, 'missing')) AS DOUBLE) AS {c}_freq_enc" for c in FREQ)
    feat = f"""feat AS (
  SELECT row_id, loan_amnt, annual_inc, int_rate, revol_util, fico_range_low, fico_range_high, dti, revol_bal,
    installment, {term_m} AS term_months, emp_length_int, fico_mean, dti_missing, term_months_missing,
    emp_length_int_missing, "default",
    loan_amnt / nullif(annual_inc, 0) AS lti, dti AS dti_ratio, {F4} AS emp_length_num,
    {EMP_BIN} AS emp_length_bin, {HISTORY} AS credit_history_years, {RATE_BIN} AS int_rate_bin,
    CAST(coalesce({term_m} > 36, false) AS DOUBLE) AS term_long,
    loan_amnt * coalesce(int_rate, (SELECT median(int_rate) FROM t2)) AS loan_x_int,
    {freq}, home_ownership, purpose, emp_title, issue_d
  FROM t2
)"""
    levels = {
        "home_ownership": ["MORTGAGE", "OWN", "RENT", "Unknown"],
        "purpose": ONEHOT["purpose"],
        "int_rate_bin": ONEHOT["int_rate_bin"],
        "emp_length_bin": ONEHOT["emp_length_bin"],
    }
    dummies = []
    for c, lv in levels.items():
        for x in lv[1:]:
            dummies.append((f"{c}_{x}", f"CAST(coalesce({c} = '{x}', false) AS INTEGER)"))
        dummies.append((f"{c}_nan", f"CAST({c} IS NULL AS INTEGER)"))
    te = """te AS (
  WITH b AS (SELECT row_id, coalesce(emp_title, 'missing') AS v, CAST("default" AS DOUBLE) AS y, row_id % 5 AS f
             FROM feat),
  vf AS (SELECT v, f, sum(y) AS s, count(*) AS n FROM b GROUP BY v, f),
  vt AS (SELECT v, sum(y) AS s_all, count(*) AS n_all FROM b GROUP BY v),
  g AS (SELECT avg(y) AS gm FROM b)
  SELECT b.row_id, coalesce(CASE WHEN vt.n_all - vf.n > 0 THEN (vt.s_all - vf.s) / (vt.n_all - vf.n) END, g.gm) AS te
  FROM b JOIN vt USING (v) JOIN vf USING (v, f), g
)"""
    base_num = ["loan_amnt", "annual_inc", "int_rate", "revol_util", "fico_range_low", "fico_range_high", "dti",
                "revol_bal", "installment", "term_months", "emp_length_int", "fico_mean", "dti_missing",
                "term_months_missing", "emp_length_int_missing", "lti", "dti_ratio", "emp_length_num",
                "credit_history_years", "term_long", "loan_x_int", "emp_title_freq_enc", "emp_length_freq_enc",
                "addr_state_freq_enc"]
    num = base_num + [d for d, _ in dummies] + ["emp_title_target_te"]
    q = lambda c: f'"{c}"'
    wide = f"""wide AS (
  SELECT f.row_id, {", ".join(f"f.{c}" for c in base_num)},
    {", ".join(f"{e} AS {q(d)}" for d, e in dummies)},
    te.te AS emp_title_target_te, f."default", f.issue_d
  FROM feat f JOIN te USING (row_id)
)"""
    flagged = ["lti", "emp_length_num"]
    med = ", ".join(f"median(CAST({q(c)} AS DOUBLE)) AS {q('m_' + c)}" for c in num)
    filled = ", ".join(f"coalesce(CAST({q(c)} AS DOUBLE), m.{q('m_' + c)}) AS {q(c)}" for c in num)
    flags = ", ".join(f"CAST({c} IS NULL AS INTEGER) AS {c}_missing" for c in flagged)
    qs = ", ".join(f"quantile_cont({q(c)}, 0.01) AS {q('lo_' + c)}, quantile_cont({q(c)}, 0.99) AS {q('hi_' + c)}"
                   for c in num)
    clipped = ", ".join(f"least(greatest({q(c)}, clipq.{q('lo_' + c)}), clipq.{q('hi_' + c)}) AS {q(c)}" for c in num)
    out = ", ".join(f"round({q(c)}, {D}) AS {q(c)}" for c in num)
    logs = ", ".join(f"round(ln(1 + greatest({c}, 0.0)), {D}) AS {c}_log1p" for c in LOGS)
    flag_cols = ", ".join(f"{c}_missing" for c in flagged)
    chain = f"""WITH {FILTERED}, {cleaned}, {t2}, {feat}, {te}, {wide},
m AS (SELECT {med} FROM wide),
filled AS (SELECT row_id, "default", issue_d, {filled}, {flags} FROM wide, m),
clipq AS (SELECT {qs} FROM filled),
clipped AS (SELECT row_id, "default", issue_d, {clipped}, {flag_cols} FROM filled, clipq)"""
    if route == "conservative":
        return chain + f"""
SELECT row_id, {out}, {flag_cols}, {logs},
       "default" AS is_default, strftime(issue_d, '%Y-%m-%d') AS issue_d
FROM clipped"""
    raw_logs = ", ".join(f"ln(1 + greatest({c}, 0.0)) AS {c}_log1p" for c in LOGS)
    scaled_cols = num + [f"{c}_missing" for c in flagged] + [f"{c}_log1p" for c in LOGS]
    stats_sql = ", ".join(f"avg({q(c)}) AS {q('a_' + c)}, stddev_pop({q(c)}) AS {q('s_' + c)}" for c in scaled_cols)
    scaled = ", ".join(
        f"round((CAST({q(c)} AS DOUBLE) - st.{q('a_' + c)}) / CASE WHEN st.{q('s_' + c)} IS NULL OR "
        f"st.{q('s_' + c)} = 0 THEN 1.0 ELSE st.{q('s_' + c)} END, {D}) AS {q(c)}"
        for c in scaled_cols)
    tab_cols = ", ".join(q(c) for c in num)
    return chain + f""",
tab AS (SELECT row_id, issue_d, "default" AS y, {tab_cols}, {flag_cols}, {raw_logs} FROM clipped),
{quota_sql('tab', 'n - ceil(0.2::DOUBLE * n)')},
ranked AS (SELECT t.*, row_number() OVER (PARTITION BY y ORDER BY row_id) AS rk FROM tab t),
labelled AS (SELECT r.*, CASE WHEN rk <= q THEN 'train' ELSE 'test' END AS split FROM ranked r JOIN quota USING (y)),
st AS (SELECT {stats_sql} FROM labelled WHERE split = 'train')
SELECT row_id, y AS is_default, split, strftime(issue_d, '%Y-%m-%d') AS issue_d, {scaled} FROM labelled, st"""


_SQL["feat_model_ready"] = with_views_sql(_model_ready_sql(), ("loans",))
_SQL["features_split"] = with_views_sql(_model_ready_sql("split"), ("loans",))


# ---------------------------------------------------------------- inputs the plain fixtures lack

@sql("band_assign_continuous", ("scored",))
def _():
    return f"""WITH s AS (SELECT row_id, {CONTINUOUS_SCORE} AS p, {HALF_ZERO_SCORE} AS z FROM scored),
e AS (SELECT list_sort(list_distinct(quantile_cont(p, {QCUT10}))) AS ep,
             list_sort(list_distinct(quantile_cont(z, {QCUT10}))) AS ez FROM s)
SELECT row_id, {band_expr('e.ep', 's.p')} AS p_band, {band_expr('e.ez', 's.z')} AS z_band FROM s, e"""


@sql("band_summary_unscored", ("scored",))
def _():
    return f"""WITH s AS (SELECT row_id, "default" AS y, CASE WHEN row_id % 4 <> 0 THEN pd_hat END AS p FROM scored),
e AS (SELECT list_sort(list_distinct(quantile_cont(p, {QCUT10}))) AS ep FROM s),
b AS (SELECT {band_expr('e.ep', 's.p')} AS band FROM s, e WHERE p IS NOT NULL),
t AS (SELECT count(*) AS n, avg(CAST(y AS DOUBLE)) AS rate FROM s)
SELECT band, count(*) AS "count", round(count(*) / max(t.n), {D}) AS population_share,
       max(t.n) AS total_observations, round(max(t.rate), {D}) AS overall_default_rate
FROM b, t GROUP BY band"""


@sql("psi_nan", ("scored",))
def _():
    v = "CASE WHEN row_id % 7 <> 0 AND row_id % 5 <> 0 THEN pd_hat END AS v"
    return f"""WITH {SCORED_SPLIT},
tr AS (SELECT {v} FROM scored_split WHERE split = 'train'),
va AS (SELECT {v} FROM scored_split WHERE split = 'validation')
SELECT round(psi, {D}) AS psi FROM {psi_sql('tr', 'va')} p"""


@sql("impute_nan", ("scored",))
def _():
    return f"""WITH s AS (SELECT row_id, CASE WHEN row_id % 7 <> 0 AND row_id % 5 <> 0 THEN dti END AS dti FROM scored),
f AS (SELECT row_id, coalesce(dti, (SELECT median(dti) FROM s)) AS dti, CAST(dti IS NULL AS INTEGER) AS dti_missing FROM s),
q AS (SELECT quantile_cont(dti, 0.01) AS lo, quantile_cont(dti, 0.99) AS hi FROM f)
SELECT row_id, round(least(greatest(dti, lo), hi), {D}) AS dti, dti_missing FROM f, q"""


@sql("feat_history_text", ("loans",))
def _():
    return f"SELECT row_id, {HISTORY} AS credit_history_years FROM loans"


@sql("folds", ("scored",))
def _():
    return """WITH r AS (SELECT row_id, row_number() OVER (PARTITION BY "default" ORDER BY row_id) AS rk,
                   count(*) OVER (PARTITION BY "default") AS n FROM scored)
SELECT row_id, CAST(CASE WHEN rk <= n // 3 + least(1, n % 3) THEN 0
                         WHEN rk <= 2 * (n // 3) + least(2, n % 3) THEN 1 ELSE 2 END AS INTEGER) AS fold FROM r"""


@sql("clean_apply_frozen", ("loans",))
def _():
    learned = IMPUTED_SELECT.format(extra="").replace("FROM filtered) m", "FROM filtered WHERE row_id % 5 <> 0) m")
    return f"WITH {FILTERED}\n{learned} WHERE row_id % 5 = 0"


@sql("train_inputs", ("loans", "scored"))
def _():
    return f"""SELECT s.row_id, s.loan_amnt, CAST({T1} AS INTEGER) AS is_default, strftime(l.issue_d, '%Y-%m-%d') AS issue_d
FROM scored s LEFT JOIN loans l USING (row_id)"""


# ---------------------------------------------------------------- stored parameters, sparse vectors

_SQL["io_outlier_params"] = _SQL["impute_clip"]
_SQL["io_scaler"] = _SQL["scale"]


@sql("enc_onehot_sparse", ("loans",))
def _():
    """Places by column, level (the fixed lists in their own order), missing last; the first level dropped."""
    cols = [*ONEHOT, "emp_title"]
    fixed = " UNION ALL ".join(
        f"SELECT {cols.index(c)} AS c, {k} AS rank, '{x}' AS level" for c in ("int_rate_bin", "emp_length_bin") for k, x in enumerate(ONEHOT[c])
    )
    free = " UNION ".join(f"SELECT {cols.index(c)}, 0, {c} FROM x WHERE {c} IS NOT NULL" for c in ("home_ownership", "purpose", "emp_title"))
    missing = ", ".join(f"({i}, 2147483647, NULL)" for i in range(len(cols)))
    long = " UNION ALL ".join(f"SELECT row_id, {i} AS c, {c} AS level FROM x" for i, c in enumerate(cols))
    return f"""WITH x AS (SELECT row_id, home_ownership, purpose, {RATE_BIN} AS int_rate_bin, {EMP_BIN} AS emp_length_bin, emp_title FROM loans),
levels AS ({fixed} UNION ALL SELECT * FROM ({free})),
kept AS (SELECT c, rank, level FROM (SELECT *, row_number() OVER (PARTITION BY c ORDER BY rank, level) AS k FROM levels) WHERE k > 1
         UNION ALL SELECT * FROM (VALUES {missing})),
placed AS MATERIALIZED (SELECT c, level, row_number() OVER (ORDER BY c, rank, level) - 1 AS place FROM kept)
SELECT l.row_id, (SELECT count(*) FROM placed)::INTEGER AS size, coalesce(string_agg(place::VARCHAR, ',' ORDER BY place), '') AS indices
FROM ({long}) l LEFT JOIN placed p ON p.c = l.c AND p.level IS NOT DISTINCT FROM l.level GROUP BY l.row_id"""
