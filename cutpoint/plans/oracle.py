"""DuckDB oracle SQL for the registered queries.

Each string runs on the driver's parquet views. Sweeps use the brute-force
rows x pairs join on purpose: it is the definition the Spark histogram
rewrite must reproduce.
"""

from __future__ import annotations

from cutpoint.functions.pairs import GRID_DEFAULTS
from cutpoint.plans import catalog as C
from cutpoint.plans.extras import REVIEW_RUN_RATE, SPOILT_EVERY, STREAM_DELAY

TXN_SQL = """txn AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
         l_shipdate AS ts, l_extendedprice AS amount, l_quantity, l_discount, l_tax,
         l_returnflag, l_linestatus,
         CAST(CASE WHEN (l_partkey*7 + l_suppkey*13) % 1000
              < 2 + CASE WHEN l_discount >= 0.08 AND l_quantity >= 40 THEN 200 ELSE 0 END
              THEN 1 ELSE 0 END AS INTEGER) AS label,
         round(1.0/(1.0+exp(-(-7.5 + 45.0*l_discount + 0.08*l_quantity + 4.0*l_tax
              + l_extendedprice/100000.0))), 6) AS score
  FROM lineitem)"""


def d(x: float) -> str:
    """A double literal (DuckDB reads bare decimals as DECIMAL)."""
    return f"CAST({float(x)!r} AS DOUBLE)"


def r6(expr: str) -> str:
    return f"round({expr}, 6)"


def ratio(a: str, b: str) -> str:
    return f"(CASE WHEN ({b}) <> 0 THEN CAST({a} AS DOUBLE) / ({b}) ELSE 0.0 END)"


def values_pairs(pairs) -> str:
    rows = ", ".join(f"(CAST({i + 1} AS BIGINT), {d(a)}, {d(b)})" for i, (a, b) in enumerate(pairs))
    return f"pairs(pair_no, t1, t2) AS (VALUES {rows})"


def grid_pairs_sql(t1_min, t1_max, t2_min, t2_max, step) -> str:
    # Both ends belong to a range; 1e-9 keeps its last value in spite of rounding.
    n1, n2 = (f"CAST(ceil(({d(hi)} + 1e-9 - {d(lo)}) / {d(step)}) AS BIGINT)" for lo, hi in ((t1_min, t1_max), (t2_min, t2_max)))
    return f"""pairs AS (
  SELECT row_number() OVER (ORDER BY i, j) AS pair_no, t1, t2 FROM (
    SELECT i, j, round({d(t1_min)} + i * {d(step)}, 4) AS t1,
                 round({d(t2_min)} + j * {d(step)}, 4) AS t2
    FROM range(0, {n1}) a(i), range(0, {n2}) b(j)) g
  WHERE t1 < t2)"""


COUNTS_SELECT = """count(*) AS total,
  count(*) FILTER (WHERE label = 1) AS fraud_total,
  count(*) FILTER (WHERE label = 0) AS nonfraud_total,
  count(*) FILTER (WHERE score < {t1}) AS approve_count,
  count(*) FILTER (WHERE score >= {t1} AND score < {t2}) AS review_count,
  count(*) FILTER (WHERE score >= {t2}) AS decline_count,
  count(*) FILTER (WHERE label = 1 AND score < {t1}) AS fraud_approve,
  count(*) FILTER (WHERE label = 1 AND score >= {t1} AND score < {t2}) AS fraud_review,
  count(*) FILTER (WHERE label = 1 AND score >= {t2}) AS fraud_decline,
  count(*) FILTER (WHERE label = 0 AND score >= {t2}) AS nonfraud_decline"""


def policy_metrics_select(keep: str = "", rnd: bool = True) -> str:
    k = f"{keep}, " if keep else ""
    r6 = globals()["r6"] if rnd else (lambda x: x)
    return f"""{k}approve_threshold, decline_threshold, approve_count, review_count, decline_count,
  {r6(ratio('approve_count', 'total'))} AS approve_rate,
  {r6(ratio('review_count', 'total'))} AS review_rate,
  {r6(ratio('decline_count', 'total'))} AS decline_rate,
  {r6(ratio('review_count + decline_count', 'total'))} AS flagged_rate,
  fraud_total, fraud_approve, fraud_review, fraud_decline,
  {r6(ratio('fraud_decline', 'fraud_total'))} AS fraud_capture_decline,
  {r6(ratio('fraud_review + fraud_decline', 'fraud_total'))} AS fraud_capture_flagged,
  {r6(ratio('nonfraud_decline', 'nonfraud_total'))} AS decline_fpr,
  {r6(ratio('fraud_review', 'review_count'))} AS review_precision,
  {r6(ratio('fraud_decline', 'decline_count'))} AS decline_precision"""


def cost_expr(c_fn, c_fd, c_rev) -> str:
    return (f"(CAST(fraud_approve AS DOUBLE) * {d(c_fn)} + CAST(nonfraud_decline AS DOUBLE) * {d(c_fd)}"
            f" + CAST(review_count AS DOUBLE) * {d(c_rev)})")


def cost_metrics_select(keep: str, c_fn, c_fd, c_rev, rnd=True) -> str:
    k = f"{keep}, " if keep else ""
    R = r6 if rnd else (lambda x: x)
    cost = cost_expr(c_fn, c_fd, c_rev)
    return f"""{k}approve_threshold, decline_threshold, approve_count, review_count, decline_count,
  {R(ratio('approve_count', 'total'))} AS approve_rate,
  {R(ratio('review_count', 'total'))} AS review_rate,
  {R(ratio('decline_count', 'total'))} AS decline_rate,
  fraud_total, fraud_approve, fraud_review, fraud_decline,
  {R(ratio('fraud_review + fraud_decline', 'fraud_total'))} AS flagged_fraud_capture,
  {R(ratio('nonfraud_decline', 'nonfraud_total'))} AS decline_fpr,
  {R(cost)} AS total_cost,
  {R(ratio(cost, 'total'))} AS cost_per_row"""


def one_policy_counts(t1, t2) -> str:
    return (f"SELECT {d(t1)} AS approve_threshold, {d(t2)} AS decline_threshold, "
            + COUNTS_SELECT.format(t1=d(t1), t2=d(t2)) + " FROM txn")


def sweep_counts_sql() -> str:
    body = COUNTS_SELECT.replace("{t1}", "p.t1").replace("{t2}", "p.t2")
    return (f"SELECT p.pair_no, p.t1 AS approve_threshold, p.t2 AS decline_threshold, {body} "
            f"FROM txn CROSS JOIN pairs p GROUP BY p.pair_no, p.t1, p.t2")


def sim_sweep_sql(pairs_cte: str, rnd: bool = True, final: bool = True) -> str:
    sql = f"""WITH {TXN_SQL}, {pairs_cte},
counts AS ({sweep_counts_sql()}),
m AS (SELECT {policy_metrics_select("pair_no, printf('policy_%02d_t1_%.4f_t2_%.4f', pair_no, approve_threshold, decline_threshold) AS policy_id", rnd)} FROM counts),
ranked AS (SELECT *, row_number() OVER (ORDER BY fraud_capture_flagged DESC, decline_precision DESC,
  review_rate ASC, decline_fpr ASC, pair_no ASC) AS rank FROM m)"""
    return sql + ("\nSELECT * FROM ranked" if final else "")


SIM_DOUBLE_COLS = ("approve_rate", "review_rate", "decline_rate", "flagged_rate",
                   "fraud_capture_decline", "fraud_capture_flagged", "decline_fpr",
                   "review_precision", "decline_precision")
SIM_OTHER_COLS = ("pair_no", "policy_id", "approve_threshold", "decline_threshold", "approve_count",
                  "review_count", "decline_count", "fraud_total", "fraud_approve", "fraud_review",
                  "fraud_decline", "rank")
VIOL_COLS = ("review_violation", "capture_violation", "decline_fpr_violation", "violation_score")


def annotate_sql(src: str, capture: str, g: dict, capture_first: bool) -> str:
    rv = f"greatest(0.0, review_rate - {d(g['max_review_rate'])})"
    cv = f"greatest(0.0, {d(g['min_capture'])} - {capture})"
    fv = f"greatest(0.0, decline_fpr - {d(g['max_decline_fpr'])})"
    score = (f"({cv} * 2.0 + {rv} * 1.0 + {fv} * 1.5)" if capture_first else
             f"({rv} * 1.0 + {cv} * 2.0 + {fv} * 1.5)")
    return f"""SELECT *, (review_rate <= {d(g['max_review_rate'])} AND {capture} >= {d(g['min_capture'])}
  AND decline_fpr <= {d(g['max_decline_fpr'])}) AS meets_guardrails,
  {rv} AS review_violation, {cv} AS capture_violation, {fv} AS decline_fpr_violation,
  {score} AS violation_score FROM {src}"""


def rounded(cols_double, cols_other, src) -> str:
    return (f"SELECT {', '.join(cols_other)}, "
            + ", ".join(f"round({c}, 6) AS {c}" for c in cols_double) + f" FROM {src}")


def cost_sweep_sql(pairs_cte: str, c_fn, c_fd, c_rev) -> str:
    return f"""WITH {TXN_SQL}, {pairs_cte},
counts AS ({sweep_counts_sql()}),
m AS (SELECT {cost_metrics_select("pair_no", c_fn, c_fd, c_rev, rnd=False)} FROM counts),
r AS (SELECT *, row_number() OVER (ORDER BY total_cost ASC, flagged_fraud_capture DESC,
  review_rate ASC, decline_fpr ASC, pair_no ASC) AS rank FROM m)"""


def _round_cost_cols(prefix="") -> str:
    cols = ["approve_rate", "review_rate", "decline_rate", "flagged_fraud_capture",
            "decline_fpr", "total_cost", "cost_per_row"]
    return ", ".join(f"round({prefix}{c}, 6) AS {c}" for c in cols)


COST_INT_COLS = ("pair_no, approve_threshold, decline_threshold, approve_count, review_count, "
                 "decline_count, fraud_total, fraud_approve, fraud_review, fraud_decline, rank")


POINTS_SQL = """pts AS (SELECT score, count(*) FILTER (WHERE label = 1) AS pos,
  count(*) FILTER (WHERE label = 0) AS neg FROM txn GROUP BY score),
c AS (SELECT score, pos, neg, CAST(sum(pos) OVER w AS BIGINT) AS tps, CAST(sum(neg) OVER w AS BIGINT) AS fps,
  row_number() OVER w AS pt, lead(pos) OVER w AS npos, lead(neg) OVER w AS nneg
  FROM pts WINDOW w AS (ORDER BY score DESC)),
tot AS (SELECT sum(pos) AS P, sum(neg) AS N, count(*) AS m FROM pts)"""


def roc_sql(prune: bool) -> str:
    cond = "WHERE pt = 1 OR pt = m OR npos <> pos OR nneg <> neg" if prune else ""
    return f"""(SELECT pt, threshold, fps, tps,
  CASE WHEN N > 0 THEN CAST(fps AS DOUBLE) / N END AS fpr,
  CASE WHEN P > 0 THEN CAST(tps AS DOUBLE) / P END AS tpr
 FROM (SELECT pt, score AS threshold, fps, tps FROM c, tot {cond}
       UNION ALL SELECT 0, CAST('inf' AS DOUBLE), 0, 0) r, tot)"""


def recall_sql(prune: bool, target: float) -> str:
    return f"""SELECT {d(target)} AS target_fpr,
  coalesce(max_by(tpr, pt) FILTER (WHERE fpr <= {d(target)}), 0.0) AS recall,
  coalesce(max_by(threshold, pt) FILTER (WHERE fpr <= {d(target)}), 1.0) AS threshold,
  {str(prune).upper()} AS pruned FROM {roc_sql(prune)} x"""


TIE_SQL = """txt AS (SELECT *, ((l_orderkey % 1000003) * 7919 + l_linenumber * 104729) % 1000003 AS tie,
  ((l_orderkey % 2147483647) * 48271 + l_linenumber * 16807 + 42) % 2147483647 AS h FROM txn)"""
TIEBREAK = ("l_orderkey, l_linenumber, l_partkey, l_suppkey, amount, l_quantity, l_discount, l_tax, "
            "l_returnflag, l_linestatus")
SPLIT_AGG = ("count(*) AS rows, CAST(sum(label) AS BIGINT) AS positives, CAST(sum(l_orderkey) AS BIGINT) AS key_sum, "
             "CAST(sum(l_linenumber) AS BIGINT) AS line_sum")


def ordered_sql() -> str:
    return f"""o AS (SELECT *, row_number() OVER (ORDER BY ts, tie, {TIEBREAK}) - 1 AS pos,
  count(*) OVER () AS n FROM txt)"""


def split_case(test_size: float) -> str:
    return f"CASE WHEN pos < CAST(floor(n * {d(1 - test_size)}) AS BIGINT) THEN 'train' ELSE 'test' END"


def scored_sql(t1, t2) -> str:
    return f"""scored AS (SELECT *, CASE WHEN score < {d(t1)} THEN 'approve' WHEN score < {d(t2)} THEN 'review'
  ELSE 'decline' END AS decision FROM txn)"""


def quantile_list(qs) -> str:
    return "[" + ", ".join(d(q) for q in qs) + "]"


def build() -> dict[str, str]:
    t1, t2 = C.T1, C.T2
    cf = C.COSTS
    q: dict[str, str] = {}
    q["contract_check"] = f"""WITH {TXN_SQL}
SELECT * FROM (VALUES ('x', TRUE, 0::BIGINT, 0::BIGINT)) v(column_name, present, null_count, nan_count) WHERE FALSE
""" + "".join(
        f"""UNION ALL SELECT '{c}' AS column_name, TRUE AS present,
  count(*) FILTER (WHERE {c} IS NULL) AS null_count,
  {f"count(*) FILTER (WHERE isnan({c}))" if c not in ("ts", "label") else "CAST(0 AS BIGINT)"} AS nan_count FROM txn
""" for c in C.REQUIRED_TXN_COLUMNS) + "UNION ALL SELECT 'channel', FALSE, -1, -1"
    q["score_band"] = f"""WITH {TXN_SQL}
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, score,
  CASE WHEN score < {d(t1)} THEN 'approve' WHEN score < {d(t2)} THEN 'review' ELSE 'decline' END AS decision
FROM txn"""
    q["predicted_class"] = f"""WITH {TXN_SQL}
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, score,
  CAST(score >= {d(t2)} AS BIGINT) AS predicted_class FROM txn"""
    q["policy_eval"] = f"""WITH {TXN_SQL}, c AS ({one_policy_counts(t1, t2)})
SELECT {policy_metrics_select()} FROM c"""
    q["policy_cost"] = f"""WITH {TXN_SQL}, c AS ({one_policy_counts(t1, t2)})
SELECT {cost_metrics_select('', cf['c_fn'], cf['c_fd'], cf['c_rev'])} FROM c"""
    q["policy_sweep"] = sim_sweep_sql(values_pairs(C.SIM_PAIRS), rnd=False, final=False) + \
        "\n" + rounded(SIM_DOUBLE_COLS, SIM_OTHER_COLS, "ranked")
    q["cost_sweep"] = cost_sweep_sql(grid_pairs_sql(**GRID_DEFAULTS), cf["c_fn"], cf["c_fd"], cf["c_rev"]) + \
        f"\nSELECT {COST_INT_COLS}, {_round_cost_cols()} FROM r"
    sg, cg = C.SIM_GUARDRAILS, C.COST_GUARDRAILS
    cost_cols_d = ("approve_rate", "review_rate", "decline_rate", "flagged_fraud_capture",
                   "decline_fpr", "total_cost", "cost_per_row")
    cost_cols_o = tuple(x.strip() for x in COST_INT_COLS.split(","))
    cost_base = cost_sweep_sql(grid_pairs_sql(**GRID_DEFAULTS), cf["c_fn"], cf["c_fd"], cf["c_rev"])
    q["guardrail_annotate"] = cost_base + f""",
a AS ({annotate_sql('r', 'flagged_fraud_capture', cg, True)})
{rounded(cost_cols_d + VIOL_COLS, cost_cols_o + ('meets_guardrails',), 'a')}"""
    sim_base = sim_sweep_sql(values_pairs(C.SIM_PAIRS), rnd=False, final=False)
    q["recommend_sim"] = sim_base + f""",
a AS ({annotate_sql('ranked', 'fraud_capture_flagged', sg, False)}),
pick AS (SELECT * FROM a ORDER BY meets_guardrails DESC,
  CASE WHEN meets_guardrails THEN rank END ASC NULLS LAST, violation_score ASC,
  fraud_capture_flagged DESC, review_rate ASC, decline_fpr ASC, rank ASC LIMIT 1)
{rounded(SIM_DOUBLE_COLS + VIOL_COLS, SIM_OTHER_COLS + ('meets_guardrails',), 'pick')}"""
    q["recommend_cost"] = cost_base + f""",
a AS ({annotate_sql('r', 'flagged_fraud_capture', cg, True)}),
pick AS (SELECT * FROM a ORDER BY meets_guardrails DESC,
  CASE WHEN NOT meets_guardrails THEN violation_score END ASC NULLS FIRST, total_cost ASC,
  flagged_fraud_capture DESC, review_rate ASC, decline_fpr ASC, rank ASC LIMIT 1)
{rounded(cost_cols_d + VIOL_COLS, cost_cols_o + ('meets_guardrails',), 'pick')}"""
    q["fallback_policy"] = sim_base + f""",
a AS ({annotate_sql('ranked', 'fraud_capture_flagged', sg, False)}),
rec AS (SELECT policy_id FROM a ORDER BY meets_guardrails DESC,
  CASE WHEN meets_guardrails THEN rank END ASC NULLS LAST, violation_score ASC,
  fraud_capture_flagged DESC, review_rate ASC, decline_fpr ASC, rank ASC LIMIT 1),
pick AS (SELECT * FROM ranked WHERE policy_id NOT IN (SELECT policy_id FROM rec)
  ORDER BY review_rate ASC, decline_fpr ASC, fraud_capture_flagged DESC, rank ASC LIMIT 1)
{rounded(SIM_DOUBLE_COLS, SIM_OTHER_COLS, 'pick')}"""
    q["promotion_gate"] = cost_base + f""",
a AS ({annotate_sql('r', 'flagged_fraud_capture', cg, True)}),
pick AS (SELECT * FROM a ORDER BY meets_guardrails DESC,
  CASE WHEN NOT meets_guardrails THEN violation_score END ASC NULLS FIRST, total_cost ASC,
  flagged_fraud_capture DESC, review_rate ASC, decline_fpr ASC, rank ASC LIMIT 1)
SELECT bool_or(meets_guardrails) AS gate_pass FROM pick"""
    c1, c2 = C.SENSITIVITY_CENTER
    offs = "(VALUES (0, -0.02), (1, -0.01), (2, 0.0), (3, 0.01), (4, 0.02))"
    npairs = f"""pairs AS (SELECT row_number() OVER (ORDER BY i, j) AS pair_no, t1, t2 FROM (
  SELECT a.i, b.j, round({d(c1)} + CAST(a.o AS DOUBLE), 4) AS t1, round({d(c2)} + CAST(b.o AS DOUBLE), 4) AS t2
  FROM {offs} a(i, o), {offs} b(j, o)) g WHERE t1 >= 0 AND t1 < t2 AND t2 <= 1)"""
    sgs = C.SENSITIVITY_GUARDRAILS
    q["sensitivity"] = sim_sweep_sql(npairs, rnd=False, final=False) + f"""
SELECT count(*) AS n_pairs, round(min(review_rate), 6) AS review_rate_min,
  round(max(review_rate), 6) AS review_rate_max, round(min(decline_fpr), 6) AS decline_fpr_min,
  round(max(decline_fpr), 6) AS decline_fpr_max, round(min(fraud_capture_flagged), 6) AS capture_min,
  round(max(fraud_capture_flagged), 6) AS capture_max,
  count(*) FILTER (WHERE review_rate <= {d(sgs['max_review_rate'])} AND fraud_capture_flagged >= {d(sgs['min_capture'])}
    AND decline_fpr <= {d(sgs['max_decline_fpr'])}) AS pass_count
FROM ranked"""
    tf = C.TARGET_FPR
    q["pr_auc"] = f"""WITH {TXN_SQL}, {POINTS_SQL}
SELECT round(CASE WHEN sum(pos) > 0 THEN sum(CAST(pos AS DOUBLE) * tps / (tps + fps)) / sum(pos) END, 6) AS pr_auc FROM c"""
    q["roc_auc"] = f"""WITH {TXN_SQL}, {POINTS_SQL}
SELECT round(CAST(sum(CAST(neg AS HUGEINT) * (2 * tps - pos)) AS DOUBLE)
  / (2.0 * CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)), 6) AS roc_auc FROM c"""
    q["recall_at_fpr"] = f"""WITH {TXN_SQL}, {POINTS_SQL}
SELECT target_fpr, round(recall, 6) AS recall, round(threshold, 6) AS threshold, pruned FROM (
{recall_sql(True, tf)} UNION ALL {recall_sql(False, tf)}) u"""
    q["roc_points"] = f"""WITH {TXN_SQL}, {POINTS_SQL}
SELECT pt, threshold, fps, tps, round(fpr, 6) AS fpr, round(tpr, 6) AS tpr FROM {roc_sql(True)} x"""
    q["suggest_t1"] = f"""WITH {TXN_SQL}, {POINTS_SQL}, r AS ({recall_sql(True, tf)}),
qq AS (SELECT quantile_cont(score, 0.9) AS t1 FROM txn)
SELECT round(t1, 6) AS t1, round(threshold, 6) AS t2, t1 > threshold AS t1_above_t2 FROM qq, r"""
    lo, hi = 0.25, 0.90
    q["default_pairs"] = f"""WITH {TXN_SQL}, {POINTS_SQL}, r AS ({recall_sql(True, tf)}),
b AS (SELECT greatest({d(lo)}, least({d(hi)}, threshold)) AS base FROM r),
raw AS (SELECT o.ord, greatest(0.0, least(0.95, o.a)) AS a,
  greatest(0.05, least(0.98, b.base + o.dd)) AS dd
  FROM b, (VALUES (0, 0.03, -0.06), (1, 0.05, -0.04), (2, 0.08, 0.0), (3, 0.10, 0.03), (4, 0.12, 0.06)) o(ord, a, dd)),
cl AS (SELECT round(a, 4) AS t1, round(dd, 4) AS t2, min(ord) AS ord FROM raw WHERE a < dd GROUP BY 1, 2),
fb AS (SELECT f.ord + 100 AS ord, f.t1, f.t2 FROM (VALUES (0, 0.03, 0.40), (1, 0.05, 0.45), (2, 0.08, 0.50), (3, 0.12, 0.60)) f(ord, t1, t2)
  WHERE NOT EXISTS (SELECT 1 FROM cl WHERE cl.t1 = f.t1 AND cl.t2 = f.t2)),
fbk AS (SELECT * FROM fb QUALIFY row_number() OVER (ORDER BY ord) <= 4 - (SELECT count(*) FROM cl)),
al AS (SELECT ord, t1, t2 FROM cl UNION ALL SELECT ord, t1, t2 FROM fbk)
SELECT row_number() OVER (ORDER BY ord) AS pair_no, round(CAST(t1 AS DOUBLE), 6) AS t1, round(CAST(t2 AS DOUBLE), 6) AS t2 FROM al"""
    ts_ = C.TEST_SIZE
    q["temporal_split"] = f"""WITH {TXN_SQL}, {TIE_SQL}, {ordered_sql()}
SELECT {split_case(ts_)} AS split, {SPLIT_AGG} FROM o GROUP BY 1"""
    cf_ = C.CALIBRATION_FRACTION
    q["calibration_split"] = f"""WITH {TXN_SQL}, {TIE_SQL}, {ordered_sql()},
k AS (SELECT *, CAST(floor(n * {d(1 - ts_)}) AS BIGINT) AS c1 FROM o),
k2 AS (SELECT *, c1 + CAST(floor((n - c1) * {d(cf_)}) AS BIGINT) AS c2 FROM k)
SELECT CASE WHEN pos < c1 THEN 'train' WHEN pos < c2 THEN 'calibration' ELSE 'evaluation' END AS split,
  {SPLIT_AGG} FROM k2 GROUP BY 1"""
    q["stratified_split"] = f"""WITH {TXN_SQL}, {TIE_SQL},
o AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY h, {TIEBREAK}, ts) AS pos,
  count(*) OVER (PARTITION BY label) AS n FROM txt)
SELECT CASE WHEN pos <= ceil(n * {d(ts_)}) THEN 'test' ELSE 'train' END AS split, CAST(label AS BIGINT) AS label,
  {SPLIT_AGG} FROM o GROUP BY 1, 2"""
    q["fixed_sample"] = f"""WITH {TXN_SQL}, {TIE_SQL}
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, h, score, CAST(label AS BIGINT) AS label FROM txt
ORDER BY h, {TIEBREAK}, txt.ts LIMIT {C.SAMPLE_SIZE}"""
    q["decision_mix"] = f"""WITH {TXN_SQL}, {scored_sql(t1, t2)}
SELECT count(*) AS rows, count(*) FILTER (WHERE decision = 'approve') AS approve_count,
  count(*) FILTER (WHERE decision = 'review') AS review_count,
  count(*) FILTER (WHERE decision = 'decline') AS decline_count,
  round(count(*) FILTER (WHERE decision = 'approve') / count(*), 6) AS approve_rate,
  round(count(*) FILTER (WHERE decision = 'review') / count(*), 6) AS review_rate,
  round(count(*) FILTER (WHERE decision = 'decline') / count(*), 6) AS decline_rate FROM scored"""
    q["score_stats"] = f"""WITH {TXN_SQL}
SELECT count(*) AS rows, round(avg(score), 6) AS mean_score,
  round(quantile_cont(score, 0.95), 6) AS p95_score, round(quantile_cont(score, 0.99), 6) AS p99_score FROM txn"""
    q["label_quality"] = f"""WITH {TXN_SQL}, {scored_sql(t1, t2)},
g AS (SELECT count(*) FILTER (WHERE label = 1) AS fraud_total, count(*) FILTER (WHERE label = 0) AS nonfraud_total,
  count(*) FILTER (WHERE label = 1 AND decision IN ('review', 'decline')) AS fraud_flagged,
  count(*) FILTER (WHERE label = 1 AND decision = 'decline') AS fraud_declined,
  count(*) FILTER (WHERE label = 0 AND decision = 'decline') AS nonfraud_declined,
  count(*) FILTER (WHERE decision = 'review') AS review_count,
  count(*) FILTER (WHERE decision = 'decline') AS decline_count FROM scored)
SELECT fraud_total, {r6(ratio('fraud_flagged', 'fraud_total'))} AS flagged_capture,
  {r6(ratio('fraud_declined', 'fraud_total'))} AS decline_capture,
  {r6(ratio('nonfraud_declined', 'nonfraud_total'))} AS decline_fpr,
  {r6(ratio('fraud_flagged - fraud_declined', 'review_count'))} AS review_precision,
  {r6(ratio('fraud_declined', 'decline_count'))} AS decline_precision FROM g"""
    import numpy as np
    qs = [float(x) for x in np.linspace(0.0, 1.0, 11)]
    split_cte = f"""{TXN_SQL}, {TIE_SQL}, {ordered_sql()},
sp AS (SELECT score, {split_case(ts_)} AS split FROM o)"""
    q["psi"] = f"""WITH {split_cte},
e AS (SELECT quantile_cont(score, {quantile_list(qs)}) AS edges FROM sp WHERE split = 'train'),
b AS (SELECT split, (SELECT count(*) FROM unnest(e.edges[2:10]) t(x) WHERE x <= sp.score) AS bin FROM sp, e),
bins AS (SELECT range AS bin FROM range(0, 10)),
h AS (SELECT bins.bin, count(*) FILTER (WHERE b.split = 'train') AS ref_n,
  count(*) FILTER (WHERE b.split = 'test') AS cur_n FROM bins LEFT JOIN b ON b.bin = bins.bin GROUP BY bins.bin),
t AS (SELECT sum(ref_n) AS rt, sum(cur_n) AS ct FROM h),
p AS (SELECT greatest(1e-8, least(1.0, CAST(ref_n AS DOUBLE) / greatest(rt, 1))) AS rp,
  greatest(1e-8, least(1.0, CAST(cur_n AS DOUBLE) / greatest(ct, 1))) AS cp FROM h, t),
v AS (SELECT sum((cp - rp) * ln(cp / rp)) AS psi FROM p)
SELECT round(psi, 6) AS psi, CASE WHEN psi < 0.1 THEN 'low' WHEN psi < 0.25 THEN 'moderate' ELSE 'high' END AS drift_level FROM v"""
    q["psi_by_segment"] = f"""WITH {TXN_SQL}, {TIE_SQL}, {ordered_sql()},
sp AS (SELECT l_returnflag, score, {split_case(ts_)} AS split FROM o),
e AS (SELECT l_returnflag, quantile_cont(score, {quantile_list(qs)}) AS edges FROM sp WHERE split = 'train' GROUP BY 1),
b AS (SELECT sp.l_returnflag, split,
  (SELECT count(*) FROM unnest(e.edges[2:10]) t(x) WHERE x <= sp.score) AS bin FROM sp JOIN e ON e.l_returnflag = sp.l_returnflag),
bins AS (SELECT e.l_returnflag, r.range AS bin FROM e, range(0, 10) r),
h AS (SELECT bins.l_returnflag, bins.bin, count(b.bin) FILTER (WHERE b.split = 'train') AS ref_n,
  count(b.bin) FILTER (WHERE b.split = 'test') AS cur_n
  FROM bins LEFT JOIN b ON b.l_returnflag = bins.l_returnflag AND b.bin = bins.bin GROUP BY 1, 2),
t AS (SELECT l_returnflag, sum(ref_n) AS rt, sum(cur_n) AS ct FROM h GROUP BY 1),
p AS (SELECT h.l_returnflag, greatest(1e-8, least(1.0, CAST(ref_n AS DOUBLE) / greatest(rt, 1))) AS rp,
  greatest(1e-8, least(1.0, CAST(cur_n AS DOUBLE) / greatest(ct, 1))) AS cp FROM h JOIN t ON t.l_returnflag = h.l_returnflag),
v AS (SELECT l_returnflag, sum((cp - rp) * ln(cp / rp)) AS psi FROM p GROUP BY 1)
SELECT l_returnflag, round(psi, 6) AS psi,
  CASE WHEN psi < 0.1 THEN 'low' WHEN psi < 0.25 THEN 'moderate' ELSE 'high' END AS drift_level FROM v"""
    q["ks_by_segment"] = f"""WITH {TXN_SQL}, {TIE_SQL}, {ordered_sql()},
sp AS (SELECT l_returnflag, score, {split_case(ts_)} AS split FROM o),
pts AS (SELECT l_returnflag, score, count(*) FILTER (WHERE split = 'train') AS r,
  count(*) FILTER (WHERE split = 'test') AS c FROM sp GROUP BY 1, 2),
n AS (SELECT l_returnflag, sum(r) AS nr, sum(c) AS nc FROM pts GROUP BY 1),
cum AS (SELECT l_returnflag, sum(r) OVER (PARTITION BY l_returnflag ORDER BY score) AS cr,
  sum(c) OVER (PARTITION BY l_returnflag ORDER BY score) AS cc FROM pts)
SELECT cum.l_returnflag, round(max(abs(CAST(cr AS DOUBLE) / greatest(nr, 1) - CAST(cc AS DOUBLE) / greatest(nc, 1))), 6) AS ks_stat,
  CAST(max(nr) AS BIGINT) AS reference_rows, CAST(max(nc) AS BIGINT) AS current_rows
FROM cum JOIN n ON n.l_returnflag = cum.l_returnflag GROUP BY cum.l_returnflag"""
    q["segment_curves"] = f"""WITH {TXN_SQL},
pts AS (SELECT l_returnflag, score, count(*) FILTER (WHERE label = 1) AS pos,
  count(*) FILTER (WHERE label = 0) AS neg FROM txn GROUP BY 1, 2),
c AS (SELECT l_returnflag, score, pos, neg, CAST(sum(pos) OVER w AS BIGINT) AS tps, CAST(sum(neg) OVER w AS BIGINT) AS fps,
  row_number() OVER w AS pt, lead(pos) OVER w AS npos, lead(neg) OVER w AS nneg
  FROM pts WINDOW w AS (PARTITION BY l_returnflag ORDER BY score DESC)),
tot AS (SELECT l_returnflag, sum(pos) AS P, sum(neg) AS N, count(*) AS m FROM pts GROUP BY 1),
auc AS (SELECT l_returnflag,
  CASE WHEN sum(pos) > 0 THEN sum(CAST(pos AS DOUBLE) * tps / (tps + fps)) / sum(pos) END AS pr_auc,
  CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN CAST(sum(CAST(neg AS HUGEINT) * (2 * tps - pos)) AS DOUBLE)
    / (2.0 * CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)) END AS roc_auc FROM c GROUP BY 1),
roc AS (SELECT c.l_returnflag, pt, score AS threshold, fps, tps FROM c JOIN tot ON tot.l_returnflag = c.l_returnflag
    WHERE pt = 1 OR pt = m OR npos <> pos OR nneg <> neg
  UNION ALL SELECT l_returnflag, 0, CAST('inf' AS DOUBLE), 0, 0 FROM tot),
r2 AS (SELECT roc.l_returnflag, pt, threshold,
  CASE WHEN N > 0 THEN CAST(fps AS DOUBLE) / N END AS fpr, CASE WHEN P > 0 THEN CAST(tps AS DOUBLE) / P END AS tpr
  FROM roc JOIN tot ON tot.l_returnflag = roc.l_returnflag),
rec AS (SELECT l_returnflag, coalesce(max_by(tpr, pt) FILTER (WHERE fpr <= {d(tf)}), 0.0) AS recall,
  coalesce(max_by(threshold, pt) FILTER (WHERE fpr <= {d(tf)}), 1.0) AS threshold FROM r2 GROUP BY 1)
SELECT auc.l_returnflag, round(pr_auc, 6) AS pr_auc, round(roc_auc, 6) AS roc_auc, {d(tf)} AS target_fpr,
  round(recall, 6) AS recall, round(threshold, 6) AS threshold FROM auc JOIN rec ON rec.l_returnflag = auc.l_returnflag"""
    q["ks_drift"] = f"""WITH {split_cte},
pts AS (SELECT score, count(*) FILTER (WHERE split = 'train') AS r, count(*) FILTER (WHERE split = 'test') AS c
  FROM sp GROUP BY score),
n AS (SELECT sum(r) AS nr, sum(c) AS nc FROM pts),
cum AS (SELECT sum(r) OVER (ORDER BY score) AS cr, sum(c) OVER (ORDER BY score) AS cc FROM pts)
SELECT round(max(abs(CAST(cr AS DOUBLE) / greatest(nr, 1) - CAST(cc AS DOUBLE) / greatest(nc, 1))), 6) AS ks_stat,
  CAST(nr AS BIGINT) AS reference_rows, CAST(nc AS BIGINT) AS current_rows FROM cum, n GROUP BY nr, nc"""
    daily = f"""{TXN_SQL}, {scored_sql(t1, t2)},
g AS (SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS day, count(*) AS rows,
  count(*) FILTER (WHERE decision = 'approve') AS approve_count,
  count(*) FILTER (WHERE decision = 'review') AS review_count,
  count(*) FILTER (WHERE decision = 'decline') AS decline_count,
  count(*) FILTER (WHERE label = 1) AS fraud_total, count(*) FILTER (WHERE label = 0) AS nonfraud_total,
  count(*) FILTER (WHERE label = 1 AND decision IN ('review', 'decline')) AS fraud_flagged,
  count(*) FILTER (WHERE label = 0 AND decision = 'decline') AS nonfraud_declined FROM scored GROUP BY 1),
dm AS (SELECT day, rows, approve_count, review_count, decline_count,
  {ratio('approve_count', 'rows')} AS approve_rate, {ratio('review_count', 'rows')} AS review_rate,
  {ratio('decline_count', 'rows')} AS decline_rate, fraud_total,
  {ratio('fraud_flagged', 'fraud_total')} AS flagged_capture,
  {ratio('nonfraud_declined', 'nonfraud_total')} AS decline_fpr FROM g)"""
    q["daily_mix"] = f"""WITH {daily}
SELECT day, rows, approve_count, review_count, decline_count, round(approve_rate, 6) AS approve_rate,
  round(review_rate, 6) AS review_rate, round(decline_rate, 6) AS decline_rate, fraud_total,
  round(flagged_capture, 6) AS flagged_capture, round(decline_fpr, 6) AS decline_fpr FROM dm"""
    q["review_alerts"] = f"""WITH {daily}
SELECT a.day, round(a.review_rate, 6) AS review_rate,
  (a.review_rate > {d(0.12)} AND coalesce(p.review_rate > {d(0.12)}, FALSE)) AS review_alert,
  a.flagged_capture < {d(0.93)} AS capture_alert, a.decline_fpr > {d(0.022)} AS fpr_alert
FROM dm a LEFT JOIN dm p ON CAST(p.day AS DATE) = CAST(a.day AS DATE) - INTERVAL 1 DAY"""
    q["segment_metrics"] = f"""WITH {TXN_SQL},
t AS (SELECT *, CAST(floor(amount / 25000.0) AS BIGINT) AS amount_bucket, CAST(year(ts) AS BIGINT) AS year FROM txn),
c AS (SELECT amount_bucket, year, {d(t1)} AS approve_threshold, {d(t2)} AS decline_threshold,
  {COUNTS_SELECT.format(t1=d(t1), t2=d(t2))} FROM t GROUP BY amount_bucket, year)
SELECT {policy_metrics_select('amount_bucket, year')} FROM c"""
    q["band_capture"] = f"""WITH {TXN_SQL}, {scored_sql(t1, t2)}
SELECT decision AS band, count(*) AS rows, count(*) FILTER (WHERE label = 1) AS fraud,
  round(CAST(count(*) FILTER (WHERE label = 1) AS DOUBLE) / (SELECT count(*) FROM txn WHERE label = 1), 6) AS fraud_share
FROM scored GROUP BY decision"""
    q["duration_percentiles"] = """SELECT event_type, count(*) AS n, round(avg(value), 6) AS mean,
  round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.95), 6) AS p95,
  round(quantile_cont(value, 0.99), 6) AS p99,
  round(count(*) * 1000.0 / sum(value), 6) AS rows_per_sec FROM events GROUP BY event_type"""
    conf_base = f"""WITH {TXN_SQL}, {POINTS_SQL}, r AS ({recall_sql(True, tf)})"""
    q["confusion"] = conf_base + f""",
g AS (SELECT count(*) FILTER (WHERE label = 0 AND score < r.threshold) AS tn,
  count(*) FILTER (WHERE label = 0 AND score >= r.threshold) AS fp,
  count(*) FILTER (WHERE label = 1 AND score < r.threshold) AS fn,
  count(*) FILTER (WHERE label = 1 AND score >= r.threshold) AS tp, r.threshold FROM txn, r GROUP BY r.threshold)
SELECT tn, fp, fn, tp, {r6(ratio('tp', 'tp + fn'))} AS recall, {r6(ratio('tp', 'tp + fp'))} AS precision,
  {r6(ratio('fp', 'fp + tn'))} AS fpr, round(threshold, 6) AS threshold FROM g"""
    q["top_errors"] = conf_base + f""",
b AS (SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, round(amount, 6) AS amount, score,
  CAST(label AS BIGINT) AS label, CAST(score >= r.threshold AS BIGINT) AS predicted_class, {TIEBREAK.replace('amount', 'amount AS amt')} FROM txn, r)
(SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, ts, amount, score, label, predicted_class, 'false_positive' AS error_type
 FROM b WHERE label = 0 AND predicted_class = 1 ORDER BY score DESC, {TIEBREAK.replace('amount', 'amt')} LIMIT {C.TOP_N})
UNION ALL
(SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, ts, amount, score, label, predicted_class, 'false_negative' AS error_type
 FROM b WHERE label = 1 AND predicted_class = 0 ORDER BY score ASC, {TIEBREAK.replace('amount', 'amt')} LIMIT {C.TOP_N})"""
    sgw = C.SIM_GUARDRAILS
    q["wide_sweep"] = sim_sweep_sql(grid_pairs_sql(**C.WIDE_GRID), rnd=False, final=False) + f""",
f AS (SELECT *, (review_rate <= {d(sgw['max_review_rate'])} AND fraud_capture_flagged >= {d(sgw['min_capture'])}
  AND decline_fpr <= {d(sgw['max_decline_fpr'])}) AS meets_guardrails FROM ranked)
{rounded(SIM_DOUBLE_COLS, SIM_OTHER_COLS + ('meets_guardrails',), 'f')}"""
    q.update(registry_sql())
    q.update(extras_sql())
    return q


def extras_sql() -> dict[str, str]:
    from cutpoint.plans import extras as X
    q: dict[str, str] = {}
    t1, t2 = C.T1, C.T2
    g1, g2 = X.PUBLISHED_PROFILES["phase2_guarded"]
    q["profile_inference"] = f"""WITH {TXN_SQL},
prof(profile, approve_threshold, decline_threshold) AS (VALUES ('primary', {d(0.11)}, {d(0.45)}),
  ('fallback', {d(0.19)}, {d(0.80)}), ('phase2_guarded', {d(g1)}, {d(g2)}),
  ('artifact', least({d(0.11)}, {d(0.45)} * {d(0.5)}), {d(0.45)})),
r AS (SELECT *, CASE WHEN l_returnflag = 'R' THEN 'fallback' WHEN l_returnflag = 'A' THEN 'primary'
  WHEN l_linestatus = 'O' THEN 'artifact' ELSE 'phase2_guarded' END AS profile FROM txn)
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey, strftime(r.ts, '%Y-%m-%d %H:%M:%S') AS ts, r.profile,
  p.approve_threshold, p.decline_threshold, score,
  CASE WHEN score < p.approve_threshold THEN 'approve' WHEN score < p.decline_threshold THEN 'review' ELSE 'decline' END AS decision,
  CAST(score >= p.decline_threshold AS BIGINT) AS predicted_class
FROM r JOIN prof p ON p.profile = r.profile"""
    a = X.APPROVE_OVERRIDE
    q["threshold_override"] = f"""WITH {TXN_SQL}, {scored_sql(a, g2)}
SELECT {d(a)} AS approve_threshold, {d(g2)} AS decline_threshold, count(*) AS rows,
  count(*) FILTER (WHERE decision = 'approve') AS approve_count,
  count(*) FILTER (WHERE decision = 'review') AS review_count,
  count(*) FILTER (WHERE decision = 'decline') AS decline_count,
  round(count(*) FILTER (WHERE decision = 'approve') / count(*), 6) AS approve_rate,
  round(count(*) FILTER (WHERE decision = 'review') / count(*), 6) AS review_rate,
  round(count(*) FILTER (WHERE decision = 'decline') / count(*), 6) AS decline_rate FROM scored"""
    q["parse_pairs"] = f"""WITH {TXN_SQL},
qq AS (SELECT CAST(year(ts) AS BIGINT) AS year, quantile_cont(score, 0.5) AS q50, quantile_cont(score, 0.9) AS q90,
  quantile_cont(score, 0.99) AS q99 FROM txn GROUP BY 1),
s AS (SELECT year, printf('%.2f', round(q50, 2)) AS a, printf('%.2f', round(q90, 2)) AS b,
  printf('%.2f', round(q99, 2)) AS c FROM qq),
toks AS (SELECT year, 1 AS pair_no, a || ':' || b AS tok FROM s UNION ALL SELECT year, 2, b || ':' || c FROM s
  UNION ALL SELECT year, 3, c || ':' || a FROM s),
p AS (SELECT year, CAST(pair_no AS BIGINT) AS pair_no, tok, CAST(split_part(tok, ':', 1) AS DOUBLE) AS t1,
  CAST(split_part(tok, ':', 2) AS DOUBLE) AS t2 FROM toks)
SELECT year, pair_no, tok, t1, t2,
  CASE WHEN NOT (t1 >= 0 AND t1 < t2 AND t2 <= 1) THEN 'invalid thresholds' END AS error FROM p"""
    body = COUNTS_SELECT.replace("{t1}", "p.t1").replace("{t2}", "p.t2")
    q["spec_sweep"] = f"""WITH {TXN_SQL}, sp AS ({q['parse_pairs']}),
counts AS (SELECT p.year, p.pair_no, p.t1 AS approve_threshold, p.t2 AS decline_threshold, {body}
  FROM txn JOIN sp p ON p.year = year(ts) AND p.error IS NULL GROUP BY 1, 2, 3, 4)
SELECT {policy_metrics_select('year, pair_no')} FROM counts"""
    q["parse_tags"] = """WITH e AS (SELECT *, json_extract_string(props, '$.k') AS k FROM events)
SELECT event_id, CAST((event_type IS NOT NULL)::INT + (user_id IS NOT NULL)::INT + (k IS NOT NULL)::INT AS BIGINT) AS n_tags,
  CAST(CASE WHEN value > 100 THEN 1 ELSE 0 END AS BIGINT) AS n_bad, event_type AS type_tag,
  CAST(user_id AS VARCHAR) AS user_tag, k AS k_tag FROM e"""
    q["report_rows"] = f"""WITH {TXN_SQL}, {scored_sql(t1, t2)},
m AS (SELECT count(*) AS rows, count(*) FILTER (WHERE decision = 'approve') / count(*) AS approve_rate,
  count(*) FILTER (WHERE decision = 'review') / count(*) AS review_rate,
  count(*) FILTER (WHERE decision = 'decline') / count(*) AS decline_rate, avg(score) AS mean_score,
  quantile_cont(score, 0.95) AS p95_score, quantile_cont(score, 0.99) AS p99_score,
  count(*) FILTER (WHERE label = 1) AS fraud_total, count(*) FILTER (WHERE label = 0) AS nonfraud_total,
  count(*) FILTER (WHERE label = 1 AND decision IN ('review', 'decline')) AS fraud_flagged,
  count(*) FILTER (WHERE label = 1 AND decision = 'decline') AS fraud_declined,
  count(*) FILTER (WHERE label = 0 AND decision = 'decline') AS nonfraud_declined,
  count(*) FILTER (WHERE decision = 'review') AS review_count,
  count(*) FILTER (WHERE decision = 'decline') AS decline_count FROM scored)
SELECT section, metric, round(value, 6) AS value FROM (
  SELECT 'volume_mix' AS section, 'rows' AS metric, CAST(rows AS DOUBLE) AS value FROM m
  UNION ALL SELECT 'volume_mix', 'approve_rate', approve_rate FROM m
  UNION ALL SELECT 'volume_mix', 'review_rate', review_rate FROM m
  UNION ALL SELECT 'volume_mix', 'decline_rate', decline_rate FROM m
  UNION ALL SELECT 'score_distribution', 'mean_score', mean_score FROM m
  UNION ALL SELECT 'score_distribution', 'p95_score', p95_score FROM m
  UNION ALL SELECT 'score_distribution', 'p99_score', p99_score FROM m
  UNION ALL SELECT 'label_quality', 'fraud_total', CAST(fraud_total AS DOUBLE) FROM m
  UNION ALL SELECT 'label_quality', 'flagged_capture', {ratio('fraud_flagged', 'fraud_total')} FROM m
  UNION ALL SELECT 'label_quality', 'decline_capture', {ratio('fraud_declined', 'fraud_total')} FROM m
  UNION ALL SELECT 'label_quality', 'decline_fpr', {ratio('nonfraud_declined', 'nonfraud_total')} FROM m
  UNION ALL SELECT 'label_quality', 'review_precision', {ratio('fraud_flagged - fraud_declined', 'review_count')} FROM m
  UNION ALL SELECT 'label_quality', 'decline_precision', {ratio('fraud_declined', 'decline_count')} FROM m) u"""
    q["scored_export"] = f"""WITH {TXN_SQL}, {scored_sql(t1, t2)}
SELECT decision, count(*) AS rows, CAST(sum(label) AS BIGINT) AS positives FROM scored GROUP BY decision"""
    k = f"(l_orderkey % {SPOILT_EVERY})"
    q["csv_quarantine"] = f"""WITH {TXN_SQL},
w AS (SELECT *, CASE WHEN {k} IN (1, 2) THEN 'malformed' WHEN {k} = 3 THEN 'label' WHEN {k} = 4 THEN 'score'
  ELSE 'loaded' END AS reason FROM txn)
SELECT reason, count(*) AS rows, CAST(NULL AS DOUBLE) AS score_sum FROM w GROUP BY reason
UNION ALL SELECT 'class ' || label, count(*), round(sum(score), 6) FROM w WHERE reason = 'loaded' GROUP BY label"""
    q["stream_daily_mix"] = f"""WITH {TXN_SQL}, {scored_sql(t1, t2)}
SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS day, count(*) AS rows,
  count(*) FILTER (WHERE decision = 'approve') AS approve_count,
  count(*) FILTER (WHERE decision = 'review') AS review_count,
  count(*) FILTER (WHERE decision = 'decline') AS decline_count,
  count(*) FILTER (WHERE label = 1) AS fraud_total,
  count(*) FILTER (WHERE label = 1 AND decision <> 'approve') AS fraud_flagged
FROM scored GROUP BY 1"""
    counts = """count(*) AS rows, count(*) FILTER (WHERE decision = 'approve') AS approve_count,
  count(*) FILTER (WHERE decision = 'review') AS review_count, count(*) FILTER (WHERE decision = 'decline') AS decline_count,
  count(*) FILTER (WHERE label = 1) AS fraud_total, count(*) FILTER (WHERE label = 1 AND decision <> 'approve') AS fraud_flagged"""
    q["stream_event_time"] = f"""WITH {TXN_SQL}, {scored_sql(t1, t2)},
mark AS (SELECT max(ts) - INTERVAL {STREAM_DELAY} AS watermark FROM txn)
SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS day,
  CASE WHEN CAST(ts AS DATE) + INTERVAL 1 DAY <= any_value(watermark) THEN 'closed' ELSE 'open' END AS state, {counts}
FROM scored, mark GROUP BY CAST(ts AS DATE)"""
    q["review_runs"] = f"""WITH {TXN_SQL}, {scored_sql(t1, t2)},
dm AS (SELECT CAST(ts AS DATE) AS day, count(*) AS rows, count(*) FILTER (WHERE decision = 'review') AS review_count
  FROM scored GROUP BY 1),
over_cap AS (SELECT *, CAST(review_count AS DOUBLE) / rows AS rate, row_number() OVER (ORDER BY day) AS k
  FROM dm WHERE CAST(review_count AS DOUBLE) / rows > {d(REVIEW_RUN_RATE)})
SELECT strftime(min(day), '%Y-%m-%d') AS run_start, strftime(max(day), '%Y-%m-%d') AS run_end, count(*) AS days,
  CAST(sum(rows) AS BIGINT) AS rows, CAST(sum(review_count) AS BIGINT) AS review_count, round(max(rate), 6) AS peak_rate
FROM over_cap GROUP BY day - CAST(k AS INTEGER)"""
    q["score_guard"] = f"""WITH {TXN_SQL}
SELECT l_returnflag, count(*) AS rows, count(*) FILTER (WHERE score IS NULL) AS null_scores,
  count(*) FILTER (WHERE isnan(score)) AS nan_scores FROM txn GROUP BY 1
UNION ALL SELECT 'bad rows', 4, 1, 2"""
    ts_, cf_ = C.TEST_SIZE, C.CALIBRATION_FRACTION
    q["calibration_none"] = f"""WITH {TXN_SQL}, {TIE_SQL}, {ordered_sql()},
k AS (SELECT *, CAST(floor(n * {d(1 - ts_)}) AS BIGINT) AS c1 FROM o),
k2 AS (SELECT *, c1 + CAST(floor((n - c1) * {d(cf_)}) AS BIGINT) AS c2 FROM k)
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, score,
  CAST(label AS BIGINT) AS label FROM k2 WHERE pos >= c2"""
    # Isotonic fit by its min-max formula: at the k-th distinct score the largest over i <= k of
    # the smallest over j >= k of the mean label of the scores i to j; between scores linear.
    q["isotonic_calibration"] = f"""WITH {TXN_SQL}, {TIE_SQL}, {ordered_sql()},
k AS (SELECT *, CAST(floor(n * {d(1 - ts_)}) AS BIGINT) AS c1 FROM o),
k2 AS (SELECT *, c1 + CAST(floor((n - c1) * {d(cf_)}) AS BIGINT) AS c2 FROM k),
p AS (SELECT score AS x, sum(label) AS y, count(*) AS w, row_number() OVER (ORDER BY score) AS i
  FROM k2 WHERE pos >= c1 AND pos < c2 GROUP BY score),
s AS (SELECT i, x, sum(y) OVER (ORDER BY i) AS sy, sum(w) OVER (ORDER BY i) AS sw, y, w FROM p),
a AS (SELECT a.i, b.i AS j, CAST(b.sy - a.sy + a.y AS DOUBLE) / (b.sw - a.sw + a.w) AS v FROM s a JOIN s b ON b.i >= a.i),
m AS (SELECT i, j, min(v) OVER (PARTITION BY i ORDER BY j DESC) AS v FROM a),
f AS (SELECT s.x, max(m.v) AS v FROM m JOIN s ON s.i = m.j GROUP BY s.x),
e AS (SELECT * FROM k2 WHERE pos >= c2),
lo AS (SELECT e.*, f.x AS x0, f.v AS v0 FROM e ASOF LEFT JOIN f ON e.score >= f.x),
hi AS (SELECT lo.*, f.x AS x1, f.v AS v1 FROM lo ASOF LEFT JOIN f ON lo.score <= f.x)
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts,
  CAST(label AS BIGINT) AS label, score AS raw_score, round(CASE WHEN x0 IS NULL THEN v1 WHEN x1 IS NULL THEN v0 WHEN x0 = x1 THEN v0
  ELSE v0 + (v1 - v0) * (score - x0) / (x1 - x0) END, 6) AS calibrated_score FROM hi"""
    tf = C.TARGET_FPR
    params = '{"target_fpr":"0.02","test_size":"0.2"}'
    tags = '{"stage":"dev","team":"risk"}'
    q["run_log"] = f"""WITH {TXN_SQL}, {POINTS_SQL}, r AS ({recall_sql(True, tf)}),
a AS (SELECT sum(CAST(pos AS DOUBLE) * tps / (tps + fps)) / sum(pos) AS pr_auc,
  CAST(sum(CAST(neg AS HUGEINT) * (2 * tps - pos)) AS DOUBLE) / (2.0 * CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)) AS roc_auc FROM c)
SELECT 'train_baseline' AS run_name, metric, round(value, 6) AS value, '{params}' AS params, '{tags}' AS tags FROM (
  SELECT 'pr_auc' AS metric, pr_auc AS value FROM a UNION ALL SELECT 'roc_auc', roc_auc FROM a
  UNION ALL SELECT 'recall_at_target_fpr', recall FROM r UNION ALL SELECT 'threshold_at_target_fpr', threshold FROM r) u"""
    q["bundle_roundtrip"] = f"""WITH {TXN_SQL}, {TIE_SQL}, {ordered_sql()}
SELECT count(*) AS rows, 0.0::DOUBLE AS max_abs_diff, 'amount,l_discount,l_quantity,l_tax' AS feature_columns
FROM o WHERE pos >= CAST(floor(n * {d(1 - ts_)}) AS BIGINT)"""
    return q


def segment_best_sql() -> str:
    """Per (part, l_returnflag): the cost-rule recommendation on the grid."""
    cf, cg = C.COSTS, C.COST_GUARDRAILS
    body = COUNTS_SELECT.replace("{t1}", "p.t1").replace("{t2}", "p.t2")
    return f"""{TXN_SQL}, {TIE_SQL}, {ordered_sql()},
sp AS (SELECT *, {split_case(C.TEST_SIZE)} AS part FROM o),
{grid_pairs_sql(**GRID_DEFAULTS)},
counts AS (SELECT part, l_returnflag, p.pair_no, p.t1 AS approve_threshold, p.t2 AS decline_threshold, {body}
  FROM sp CROSS JOIN pairs p GROUP BY part, l_returnflag, p.pair_no, p.t1, p.t2),
m AS (SELECT {cost_metrics_select("part, l_returnflag, pair_no", cf['c_fn'], cf['c_fd'], cf['c_rev'], rnd=False)} FROM counts),
r AS (SELECT *, row_number() OVER (PARTITION BY part, l_returnflag ORDER BY total_cost ASC,
  flagged_fraud_capture DESC, review_rate ASC, decline_fpr ASC, pair_no ASC) AS rank FROM m),
a AS ({annotate_sql('r', 'flagged_fraud_capture', cg, True)}),
best AS (SELECT * FROM a QUALIFY row_number() OVER (PARTITION BY part, l_returnflag ORDER BY meets_guardrails DESC,
  CASE WHEN NOT meets_guardrails THEN violation_score END ASC NULLS FIRST, total_cost ASC,
  flagged_fraud_capture DESC, review_rate ASC, decline_fpr ASC, rank ASC) = 1)"""


def registry_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    g = C.COST_GUARDRAILS
    q["policy_profiles"] = f"""WITH {segment_best_sql()}
SELECT l_returnflag AS doc_id, 'primary' AS profile, 0.11::DOUBLE AS approve_threshold, 0.45::DOUBLE AS decline_threshold,
  'week3' AS source, TRUE AS valid FROM best WHERE part = 'train'
UNION ALL SELECT l_returnflag, 'fallback', 0.19::DOUBLE, 0.80::DOUBLE, 'week3', TRUE FROM best WHERE part = 'train'
UNION ALL SELECT l_returnflag, 'phase2_guarded', approve_threshold, decline_threshold, 'phase2_optimization',
  approve_threshold >= 0 AND approve_threshold < decline_threshold AND decline_threshold <= 1 FROM best WHERE part = 'train'"""
    q["policy_registry_check"] = f"""WITH {segment_best_sql()}
SELECT CASE WHEN part = 'train' THEN 'current/' ELSE 'fresh/' END || l_returnflag AS doc_id,
  CAST(0 AS BIGINT) AS violations, TRUE AS valid FROM best
UNION ALL SELECT 'version/' || l_returnflag, 1, FALSE FROM best WHERE part = 'train'
UNION ALL SELECT 'profile/' || l_returnflag, 1, FALSE FROM best WHERE part = 'train'
UNION ALL SELECT 'range/' || l_returnflag, 2, FALSE FROM best WHERE part = 'train'
UNION ALL SELECT 'broken/' || l_returnflag, 1, FALSE FROM best WHERE part = 'train'"""
    q["policy_recompute_drift"] = "SELECT 'policy' AS doc_id, CAST(0 AS BIGINT) AS violations, TRUE AS valid, CAST(0 AS BIGINT) AS differences"
    q["policy_status"] = f"""WITH {segment_best_sql()}
SELECT l_returnflag AS doc_id, CAST(1 AS BIGINT) AS schema_version, 'phase2_guarded' AS default_policy_profile,
  'phase2_guarded' AS selected_policy_profile, 'fallback,phase2_guarded,primary' AS available_profiles,
  {d(g['max_review_rate'])} AS max_review_rate, {d(g['min_capture'])} AS min_flagged_fraud_capture,
  {d(g['max_decline_fpr'])} AS max_decline_fpr, approve_threshold, decline_threshold,
  'phase2_optimization' AS source, 'none' AS calibration_method, meets_guardrails,
  round(review_rate, 6) AS review_rate, round(decline_fpr, 6) AS decline_fpr,
  round(flagged_fraud_capture, 6) AS flagged_fraud_capture, round(total_cost, 6) AS total_cost,
  round(cost_per_row, 6) AS cost_per_row FROM best WHERE part = 'train'"""
    q["policy_drift"] = f"""WITH {segment_best_sql()},
k AS (SELECT part, l_returnflag, 'profile phase2_guarded' AS scope, 'approve_threshold' AS key, approve_threshold AS value FROM best
  UNION ALL SELECT part, l_returnflag, 'profile phase2_guarded', 'decline_threshold', decline_threshold FROM best),
c AS (SELECT * FROM k WHERE part = 'train'), f AS (SELECT * FROM k WHERE part = 'test')
SELECT coalesce(c.l_returnflag, f.l_returnflag) AS doc_id, coalesce(c.scope, f.scope) AS scope, coalesce(c.key, f.key) AS key,
  coalesce(c.value, 0.0) AS current, coalesce(f.value, 0.0) AS fresh
FROM c FULL OUTER JOIN f ON c.l_returnflag = f.l_returnflag AND c.scope = f.scope AND c.key = f.key
WHERE abs(coalesce(c.value, 0.0) - coalesce(f.value, 0.0)) > 1e-6"""
    q["policy_roundtrip"] = f"""WITH {segment_best_sql()}
SELECT l_returnflag AS doc_id, TRUE AS same FROM best WHERE part = 'train'"""
    return q
