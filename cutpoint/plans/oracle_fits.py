"""DuckDB SQL for model fits: accelerated gradient steps in a recursive table.

The objective of a class-balanced ridge logistic fit is convex, so every solver that converges
finds the same numbers. Rows are centred and scaled first, which bounds the curvature by
(1 + features) / 4 and so allows one fixed step.
"""

from __future__ import annotations

from collections.abc import Sequence

from cutpoint.functions.pairs import GRID_DEFAULTS
from cutpoint.operators.model import default_candidates
from cutpoint.operators.scorecard import INPUT_PLACES, POINT_PLACES, SCORE_PLACES
from cutpoint.operators.monitor import psi_quantiles
from cutpoint.plans import catalog as C
from cutpoint.plans import oracle
from cutpoint.plans.extras import PUBLISHED_PROFILES
from cutpoint.plans.models import FIT_PLACES
from cutpoint.plans.oracle import POINTS_SQL, TIE_SQL, TXN_SQL, annotate_sql, d, grid_pairs_sql, ordered_sql, ratio, recall_sql
from cutpoint.plans.reports import COST, EXPERIMENT, LATENCY, SHOWN, SIMULATION, TARGET_P95
from cutpoint.sources.policy_doc import FALLBACK, PRIMARY
from cutpoint.sources.tables import TXN_FEATURES

STEPS = 500
MOMENTUM = 0.9


def three_way_sql() -> str:
    """``part``: the rows with ``split`` in train, calibration and evaluation."""
    return f"""{TXN_SQL}, {TIE_SQL}, {ordered_sql()},
k1 AS (SELECT *, CAST(floor(n * {d(1 - C.TEST_SIZE)}) AS BIGINT) AS c1 FROM o),
k2 AS (SELECT *, c1 + CAST(floor((n - c1) * {d(C.CALIBRATION_FRACTION)}) AS BIGINT) AS c2 FROM k1),
part AS MATERIALIZED (SELECT * EXCLUDE (pos, n, c1, c2, tie, h),
  CASE WHEN pos < c1 THEN 'train' WHEN pos < c2 THEN 'calibration' ELSE 'evaluation' END AS split FROM k2)"""


def scaled_sql(source: str, features: Sequence[str], balanced: bool = True) -> str:
    """``st``: counts, means and deviations of ``source``; ``z``: its rows as y, w, z1 .. zk."""
    stats = ", ".join(f"avg(CAST({c} AS DOUBLE)) AS m{i}, stddev_pop(CAST({c} AS DOUBLE)) AS s{i}"
                      for i, c in enumerate(features, 1))
    weight = "n_rows / (2.0 * CASE WHEN label = 1 THEN n_positive ELSE n_rows - n_positive END)" if balanced else "1.0"
    return f"""st AS MATERIALIZED (SELECT count(*) AS n_rows, count(*) FILTER (WHERE label = 1) AS n_positive, {stats} FROM {source}),
z AS MATERIALIZED (SELECT CAST(label AS DOUBLE) AS y, {weight} AS w, {', '.join(f'({c} - m{i}) / s{i} AS z{i}' for i, c in enumerate(features, 1))}
  FROM {source}, st)"""


def fit_sql(candidates: str, k: int, steps: int = STEPS) -> str:
    """``fit``: one row per row of ``candidates`` (cand, p1 .. pk: the penalty of each coefficient,
    over the number of rows) with the optimum b0 (intercept), b1 .. bk over ``z``.
    Needs WITH RECURSIVE."""
    step, all_ = 4.0 / (k + 1), range(k + 1)
    line = "v0 + " + " + ".join(f"v{i} * z{i}" for i in all_ if i)
    pens = ", ".join(f"p{i}" for i in all_ if i)
    grads = ", ".join(f"sum(w * (q - y){f' * z{i}' if i else ''}) / count(*) AS g{i}" for i in all_)
    keep = ", ".join(f"any_value(b{i}) AS b{i}, any_value(v{i}) AS v{i}" for i in all_)
    keep_pens = ", ".join(f"any_value(p{i}) AS p{i}" for i in all_ if i)
    moved = ", ".join(f"v{i} - {step} * (g{i}{f' + p{i} * v{i}' if i else ''}) AS n{i}" for i in all_)
    return f"""steps AS (
  SELECT cand, 0 AS it, {pens}, {', '.join(f'CAST(0 AS DOUBLE) AS b{i}, CAST(0 AS DOUBLE) AS v{i}' for i in all_)} FROM {candidates}
  UNION ALL
  SELECT cand, it + 1, {pens}, {', '.join(f'n{i}, n{i} + {MOMENTUM} * (n{i} - b{i})' for i in all_)} FROM (
    SELECT cand, it, {pens}, {', '.join(f'b{i}' for i in all_)}, {moved} FROM (
      SELECT cand, it, {keep_pens}, {keep}, {grads}
      FROM (SELECT *, 1.0 / (1.0 + exp(-({line}))) AS q FROM steps, z WHERE it < {steps}) GROUP BY cand, it))),
fit AS MATERIALIZED (SELECT cand, {', '.join(f'b{i}' for i in all_)} FROM steps WHERE it = {steps})"""


def case_profile(column: dict) -> str:
    return "CASE profile " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in column.items()) + " END"


def model_inference_sql() -> str:
    n = len(TXN_FEATURES)
    r = lambda x, p: f"round({x}, {p})"
    line = f"{r('b0', POINT_PLACES)}" + "".join(
        f" + {r(f'b{i}', POINT_PLACES)} * ((CAST({c} AS DOUBLE) - {r(f'm{i}', INPUT_PLACES)}) / {r(f's{i}', INPUT_PLACES)})"
        for i, c in enumerate(TXN_FEATURES, 1))
    t1 = {"primary": d(PRIMARY[0]), "fallback": d(FALLBACK[0]), "artifact": f"least({d(0.11)}, b_threshold * 0.5)",
          **{k: d(a) for k, (a, _) in PUBLISHED_PROFILES.items()}}
    t2 = {"primary": d(PRIMARY[1]), "fallback": d(FALLBACK[1]), "artifact": "b_threshold",
          **{k: d(b) for k, (_, b) in PUBLISHED_PROFILES.items()}}
    return f"""WITH RECURSIVE {three_way_sql()},
tr AS (SELECT * FROM part WHERE split = 'train'), {scaled_sql('tr', TXN_FEATURES)},
cands AS (SELECT 1 AS cand, {', '.join(f'CAST(1 AS DOUBLE) / n_rows AS p{i}' for i in range(1, n + 1))} FROM st),
{fit_sql('cands', n)},
served AS MATERIALIZED (SELECT part.* EXCLUDE (score), round(1.0 / (1.0 + exp(-({line}))), {SCORE_PLACES}) AS score FROM part, fit, st
  WHERE split <> 'train'),
txn2 AS (SELECT score, label FROM served WHERE split = 'calibration'), {POINTS_SQL.replace('FROM txn ', 'FROM txn2 ')},
thr AS (SELECT threshold AS b_threshold FROM ({recall_sql(True, C.TARGET_FPR)})),
prof AS (SELECT served.*, CASE WHEN l_returnflag = 'R' THEN 'fallback' WHEN l_returnflag = 'A' THEN 'primary'
  WHEN l_linestatus = 'O' THEN 'artifact' ELSE 'phase2_guarded' END AS profile FROM served WHERE split = 'evaluation'),
res AS (SELECT prof.*, {case_profile(t1)} AS approve_threshold, {case_profile(t2)} AS decline_threshold FROM prof, thr)
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey,
  strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, CAST(label AS BIGINT) AS label, profile,
  round(approve_threshold, 6) AS approve_threshold, round(decline_threshold, 6) AS decline_threshold, score,
  CAST(score >= decline_threshold AS BIGINT) AS predicted_class,
  CASE WHEN score < approve_threshold THEN 'approve' WHEN score < decline_threshold THEN 'review' ELSE 'decline' END AS decision
FROM res"""


def stats_columns() -> str:
    return ", ".join(f"round(m{i}, 6) AS mean_{c}, round(s{i}, 6) AS std_{c}" for i, c in enumerate(TXN_FEATURES, 1))


def logreg_fit_sql() -> str:
    """The raw fit in scaled coordinates: a raw coefficient is the scaled one over the deviation."""
    n = len(TXN_FEATURES)
    return f"""WITH RECURSIVE {three_way_sql()},
tr AS (SELECT * FROM part WHERE split = 'train'), {scaled_sql('tr', TXN_FEATURES)},
cands AS (SELECT 1 AS cand, {', '.join(f'1.0 / (s{i} * s{i} * n_rows) AS p{i}' for i in range(1, n + 1))} FROM st),
{fit_sql('cands', n)}
SELECT 'raw_logreg_c1.0' AS candidate, TRUE AS gradient_small, n_rows AS train_rows,
  round(n_rows / (2.0 * n_positive), 6) AS weight_positive, round(n_rows / (2.0 * (n_rows - n_positive)), 6) AS weight_negative,
  {stats_columns()}, {', '.join(f'round(b{i}, {FIT_PLACES}) AS effect_{c}' for i, c in enumerate(TXN_FEATURES, 1))},
  round(b0, {FIT_PLACES}) AS intercept FROM fit, st"""


def points_by_sql(source: str, by: str) -> str:
    """Distinct scores of each group with running counts, ROC points and their totals."""
    return f"""pts AS (SELECT {by}, score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg
  FROM {source} GROUP BY {by}, score),
c AS (SELECT {by}, score, pos, neg, CAST(sum(pos) OVER w AS BIGINT) AS tps, CAST(sum(neg) OVER w AS BIGINT) AS fps,
  row_number() OVER w AS pt, lead(pos) OVER w AS npos, lead(neg) OVER w AS nneg
  FROM pts WINDOW w AS (PARTITION BY {by} ORDER BY score DESC)),
tot AS (SELECT {by}, sum(pos) AS P, sum(neg) AS N, count(*) AS m FROM pts GROUP BY {by}),
auc AS (SELECT {by}, sum(CAST(pos AS DOUBLE) * tps / (tps + fps)) / sum(pos) AS pr_auc,
  CAST(sum(CAST(neg AS HUGEINT) * (2 * tps - pos)) AS DOUBLE) / (2.0 * CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)) AS roc_auc
  FROM c GROUP BY {by}),
kept AS (SELECT c.{by}, pt, score AS threshold, CAST(fps AS DOUBLE) / N AS fpr, CAST(tps AS DOUBLE) / P AS tpr
  FROM c JOIN tot USING ({by}) WHERE pt = 1 OR pt = m OR npos <> pos OR nneg <> neg),
rec AS (SELECT auc.{by}, coalesce(max_by(tpr, pt) FILTER (WHERE fpr <= {d(C.TARGET_FPR)}), 0.0) AS recall,
  coalesce(max_by(threshold, pt) FILTER (WHERE fpr <= {d(C.TARGET_FPR)}), CASE WHEN count(kept.pt) > 0 THEN CAST('inf' AS DOUBLE) ELSE 1.0 END) AS threshold
  FROM auc LEFT JOIN kept USING ({by}) GROUP BY auc.{by})"""


def model_sweep_sql() -> str:
    n, cands = len(TXN_FEATURES), default_candidates()
    rows = " UNION ALL ".join(
        f"SELECT CAST({k} AS BIGINT) AS cand, '{c.name}' AS candidate, " + ", ".join(
            f"1.0 / ({d(c.c_value)} * n_rows{'' if c.scaled else f' * s{i} * s{i}'}) AS p{i}" for i in range(1, n + 1)) + " FROM st"
        for k, c in enumerate(cands, 1))
    line = "b0" + "".join(f" + b{i} * (({c} - m{i}) / s{i})" for i, c in enumerate(TXN_FEATURES, 1))
    return f"""WITH RECURSIVE {three_way_sql()},
tr AS (SELECT * FROM part WHERE split = 'train'), {scaled_sql('tr', TXN_FEATURES)},
cands AS MATERIALIZED ({rows}), {fit_sql('cands', n)},
scored AS MATERIALIZED (SELECT cand, label, 1.0 / (1.0 + exp(-({line}))) AS score FROM part, st, fit WHERE split <> 'train'),
{points_by_sql('scored', 'cand')}
SELECT cand AS candidate_no, candidate, round(pr_auc, 6) AS pr_auc, round(roc_auc, 6) AS roc_auc,
  round(recall, 6) AS recall_at_target_fpr, round(threshold, {FIT_PLACES}) AS threshold_at_target_fpr,
  row_number() OVER (ORDER BY recall DESC, pr_auc DESC, roc_auc DESC, cand) AS model_rank
FROM auc JOIN rec USING (cand) JOIN cands USING (cand)"""


def platt_sql(source: str) -> str:
    """``pl``: slope and intercept of the unweighted fit of label on score over ``source``."""
    return f"""{scaled_sql(source, ['score'], balanced=False)},
cands AS (SELECT 1 AS cand, 1.0 / (s1 * s1 * n_rows) AS p1 FROM st), {fit_sql('cands', 1)},
pl AS MATERIALIZED (SELECT b1 / s1 AS slope, b0 - b1 * m1 / s1 AS intercept, n_rows FROM fit, st)"""


def platt_calibration_sql() -> str:
    return f"""WITH RECURSIVE {three_way_sql()},
cal AS (SELECT score, label FROM part WHERE split = 'calibration'), {platt_sql('cal')}
SELECT 'platt' AS method, TRUE AS gradient_small, n_rows AS rows, round(slope, {FIT_PLACES}) AS slope,
  round(intercept, {FIT_PLACES}) AS intercept FROM pl"""


def optimizer_job_sql() -> str:
    """Each method's calibrated scores, the sweep as rows x pairs, and the two choices."""
    cost = C.COSTS
    keys = "total_cost ASC, flagged_fraud_capture DESC, review_rate ASC, decline_fpr ASC"
    return f"""WITH RECURSIVE {three_way_sql()},
cal AS MATERIALIZED (SELECT score, label FROM part WHERE split = 'calibration'),
ev AS MATERIALIZED (SELECT score, label, count(*) AS k FROM part WHERE split = 'evaluation' GROUP BY score, label),
{platt_sql('cal')},
p AS (SELECT score AS x, sum(label) AS y, count(*) AS w, row_number() OVER (ORDER BY score) AS i FROM cal GROUP BY score),
s AS (SELECT i, x, sum(y) OVER (ORDER BY i) AS sy, sum(w) OVER (ORDER BY i) AS sw, y, w FROM p),
a AS (SELECT a.i, b.i AS j, CAST(b.sy - a.sy + a.y AS DOUBLE) / (b.sw - a.sw + a.w) AS v FROM s a JOIN s b ON b.i >= a.i),
m AS (SELECT i, j, min(v) OVER (PARTITION BY i ORDER BY j DESC) AS v FROM a),
f AS MATERIALIZED (SELECT s.x, max(m.v) AS v FROM m JOIN s ON s.i = m.j GROUP BY s.x),
lo AS (SELECT ev.*, f.x AS x0, f.v AS v0 FROM ev ASOF LEFT JOIN f ON ev.score >= f.x),
hi AS (SELECT lo.*, f.x AS x1, f.v AS v1 FROM lo ASOF LEFT JOIN f ON lo.score <= f.x),
u AS MATERIALIZED (
  SELECT 'none' AS method, CAST(1 AS BIGINT) AS method_no, score, label, k FROM ev
  UNION ALL SELECT 'platt', 2, 1.0 / (1.0 + exp(-(intercept + slope * score))), label, k FROM ev, pl
  UNION ALL SELECT 'isotonic', 3, CASE WHEN x0 IS NULL THEN v1 WHEN x1 IS NULL THEN v0 WHEN x0 = x1 OR v0 = v1 THEN v0
    ELSE v0 + (v1 - v0) * (score - x0) / (x1 - x0) END, label, k FROM hi),
{grid_pairs_sql(**GRID_DEFAULTS)},
n AS (SELECT method, method_no, pair_no, t1 AS approve_threshold, t2 AS decline_threshold, sum(k) AS total,
  coalesce(sum(k) FILTER (WHERE label = 1), 0) AS fraud_total, coalesce(sum(k) FILTER (WHERE label = 0), 0) AS nonfraud_total,
  coalesce(sum(k) FILTER (WHERE score >= t1 AND score < t2), 0) AS review_count,
  coalesce(sum(k) FILTER (WHERE label = 1 AND score < t1), 0) AS fraud_approve,
  coalesce(sum(k) FILTER (WHERE label = 1 AND score >= t1), 0) AS fraud_flagged,
  coalesce(sum(k) FILTER (WHERE label = 0 AND score >= t2), 0) AS nonfraud_decline
  FROM u CROSS JOIN pairs GROUP BY 1, 2, 3, 4, 5),
r AS (SELECT *, {ratio('review_count', 'total')} AS review_rate, {ratio('fraud_flagged', 'fraud_total')} AS flagged_fraud_capture,
  {ratio('nonfraud_decline', 'nonfraud_total')} AS decline_fpr,
  CAST(fraud_approve AS DOUBLE) * {d(cost['c_fn'])} + CAST(nonfraud_decline AS DOUBLE) * {d(cost['c_fd'])}
    + CAST(review_count AS DOUBLE) * {d(cost['c_rev'])} AS total_cost FROM n),
g AS ({annotate_sql('r', 'flagged_fraud_capture', C.COST_GUARDRAILS, True)}),
o2 AS (SELECT *, row_number() OVER (PARTITION BY method ORDER BY meets_guardrails DESC,
  CASE WHEN NOT meets_guardrails THEN violation_score END ASC NULLS FIRST, {keys}, pair_no) AS pick FROM g),
best AS (SELECT *, row_number() OVER (ORDER BY meets_guardrails DESC, {keys}, method_no) AS place FROM o2 WHERE pick = 1)
SELECT method, method_no, approve_threshold, decline_threshold, round(total_cost, 6) AS total_cost,
  round({ratio('total_cost', 'total')}, 6) AS cost_per_row, round(review_rate, 6) AS review_rate, round(decline_fpr, 6) AS decline_fpr,
  round(flagged_fraud_capture, 6) AS flagged_fraud_capture, meets_guardrails, place = 1 AS is_best FROM best"""


def long_sql(report: str, item: str, source: str, metrics: Sequence[str]) -> str:
    """One row per row of the query ``source`` and metric."""
    names = ", ".join(f"'{m}'" for m in metrics)
    values = ", ".join(f"CAST({m} AS DOUBLE)" for m in metrics)
    return f"SELECT '{report}' AS report, {item} AS item, unnest([{names}]) AS metric, unnest([{values}]) AS value FROM ({source}) x"


def report_sections_sql(q: dict[str, str]) -> str:
    """From the SQL of the queries behind the sections; observed sections are counted here."""
    t1, t2 = d(C.T1), d(C.T2)
    volume = f"""SELECT count(*) AS rows, count(*) FILTER (WHERE score < {t1}) AS approve_count,
  count(*) FILTER (WHERE score >= {t1} AND score < {t2}) AS review_count, count(*) FILTER (WHERE score >= {t2}) AS decline_count,
  round(avg(score), 6) AS mean_score, max(score) AS max_score FROM txn"""
    errors = f"SELECT *, fpr AS realized_fpr, threshold AS selected_threshold, fp + fn AS exported_errors FROM ({q['confusion']}) c"
    psi_bins = f"""SELECT bin, count(*) FILTER (WHERE pop = 'ref') AS r, count(*) FILTER (WHERE pop = 'cur') AS c FROM pop, edges
  , LATERAL (SELECT len(list_filter(e, lambda v: v <= score)) AS bin) b GROUP BY bin"""
    psi = f"""SELECT round(sum((cp - rp) * ln(cp / rp)), 6) AS psi,
  CASE WHEN sum((cp - rp) * ln(cp / rp)) < 0.1 THEN 1 WHEN sum((cp - rp) * ln(cp / rp)) < 0.25 THEN 2 ELSE 3 END AS drift_level_no
FROM (SELECT greatest(1e-8, coalesce(r, 0) / (SELECT count(*) FROM pop WHERE pop = 'ref')::DOUBLE) AS rp,
  greatest(1e-8, coalesce(c, 0) / (SELECT count(*) FROM pop WHERE pop = 'cur')::DOUBLE) AS cp
  FROM range(0, 10) g(bin) LEFT JOIN ({psi_bins}) h USING (bin))"""
    fractions = "[" + ", ".join(d(x) for x in psi_quantiles(10)[1:-1]) + "]"
    drift = f"SELECT count(*) AS differences, count(*) = 0 AS passed FROM ({q['policy_drift']}) p"
    timed = f"SELECT *, p95 <= {d(TARGET_P95)} AS meets_target FROM ({q['duration_percentiles']}) t"
    parts = [
        long_sql("inference", "'all'", volume, ("rows", "approve_count", "review_count", "decline_count", "mean_score", "max_score")),
        long_sql("error_analysis", "'all'", errors, ("tn", "fp", "fn", "tp", "recall", "precision", "realized_fpr", "selected_threshold",
                                                      "exported_errors")),
        long_sql("monitoring", "'reference'", psi, ("psi", "drift_level_no")),
        long_sql("policy_simulation", "policy_id", q["policy_sweep"], SIMULATION),
        long_sql("policy_simulation", "'recommended'", q["recommend_sim"], (*SIMULATION, "meets_guardrails")),
        long_sql("cost_policy", "'recommended'", q["recommend_cost"], COST),
        long_sql("policy_drift", "'registry'", drift, ("differences", "passed")),
        long_sql("latency", "event_type", timed, (*LATENCY, "meets_target"))]
    return f"""WITH {TXN_SQL},
pop AS (SELECT 'ref' AS pop, score FROM txn UNION ALL SELECT 'cur', score FROM txn WHERE l_returnflag = 'R'),
edges AS (SELECT quantile_cont(score, {fractions}) AS e FROM pop WHERE pop = 'ref')
""" + "\nUNION ALL ".join(parts)


def report_text_sql(simulation: str) -> str:
    rates = ", ".join(f"printf('%.2f%%', round({c}, 4) * 100) AS {c}" for c in SHOWN)
    return f"""SELECT rank, policy_id, printf('%.4f', round(approve_threshold, 4)) AS t1, printf('%.4f', round(decline_threshold, 4)) AS t2,
  {rates} FROM ({simulation}) s"""


def build() -> dict[str, str]:
    out = {"model_inference": model_inference_sql(), "logreg_fit": logreg_fit_sql(), "model_sweep": model_sweep_sql(),
           "platt_calibration": platt_calibration_sql(), "optimizer_job": optimizer_job_sql()}
    core = oracle.build()
    out["report_sections"], out["report_text"] = report_sections_sql(core), report_text_sql(core["policy_sweep"])
    out["report_experiments"] = long_sql("experiments", "candidate", out["model_sweep"], EXPERIMENT)
    return out
