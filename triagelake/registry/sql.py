"""SQL for each registered query that SQL can express on whole tables."""

from __future__ import annotations

from ..functions.lexicon import SENTINELS
from ..functions.text import BLANKS
from ..operators.presentation import HEADINGS
from ..plans.driver_tables import LEXICONS
from .oracles import (
    COST, CUES, DEPS, EVAL, GUARD, IMPACT, RISK, ROUTE, SCORED, SLA_ROWS, TXT, char_grams_sql, class_report_sql, d,
    ece_bins_sql, norm, q, qhat_sql, quota_sql, sla_sql,
)

SQL: dict[str, str] = {}
CUE_WORDS = sorted({c for s in LEXICONS.polarity().values() for c in s.cues})
NEGATORS = q(LEXICONS.negators)
BLANK_SQL = " || ".join(f"chr({ord(b)})" for b in BLANKS)


def w(ctes: str, body: str) -> str:
    return f"WITH {ctes.strip()} {body}"


# --- text and lexicon
SQL["text_normalize"] = w(TXT, "SELECT id, text FROM txt")
SQL["title_body_merge"] = w(TXT + f", b AS (SELECT {BLANK_SQL} AS blanks)", """
SELECT id, concat_ws(' ', nullif(trim(title, blanks), ''), nullif(trim(body, blanks), ''), nullif(trim(body, blanks), '')) AS merged FROM rev, b""")
_SAFE = f"""
, b AS (SELECT {BLANK_SQL} AS blanks),
line AS (SELECT id, CASE WHEN trim(replace(body, chr(10), ' '), blanks) = '' THEN 'vuoto' ELSE trim(replace(body, chr(10), ' '), blanks) END AS line FROM rev, b)
"""
SQL["text_safe"] = w(TXT + _SAFE, "SELECT id, line FROM line")
_marks = []
for _token, _cues, _whole in SENTINELS:
    _tests = " OR ".join(
        f"contains(' ' || lower(line) || ' ', ' {c} ')" if _whole else f"contains(lower(line), '{c}')" for c in _cues
    )
    _marks.append(f"CASE WHEN {_tests} THEN '{_token}' END")
SQL["sentinel_tokens"] = w(TXT + _SAFE, f"SELECT id, concat_ws(' ', line, {', '.join(_marks)}) AS enriched FROM line")
SQL["lexicon_polarity"] = w(CUES, """
SELECT id, CAST(neg_s AS INTEGER) AS negative_score, CAST(haz_s AS INTEGER) AS hazard_score, CAST(pos_s AS INTEGER) AS positive_score FROM sc""")
_WORDS = TXT + """
, pos AS (SELECT id, unnest(tk) AS w, generate_subscripts(tk, 1) AS i FROM tok),
lagged AS (SELECT id, w, lag(w, 1) OVER o AS w1, lag(w, 2) OVER o AS w2 FROM pos WINDOW o AS (PARTITION BY id ORDER BY i)),
flag AS (SELECT id, w, coalesce(w1 IN ({n}), false) OR coalesce(w2 IN ({n}), false) AS neg FROM lagged)
""".format(n=NEGATORS)
_lex = " UNION ALL ".join(
    f"SELECT '{name}' AS lexicon, unnest([{q(sorted(set(s.cues)))}]) AS cue" for name, s in LEXICONS.polarity().items()
)
SQL["lexicon_by_join"] = w(CUES, " UNION ALL ".join(
    f"SELECT id, '{name}' AS lexicon, CAST({score} AS BIGINT) AS score FROM sc" for name, score in (("negative", "neg_s"), ("hazard", "haz_s"), ("positive", "pos_s"))))
SQL["lexicon_unmatched"] = w(_WORDS + f", lex AS ({_lex})", """
SELECT w AS cue, count(*) AS n FROM pos WHERE w NOT IN (SELECT cue FROM lex) GROUP BY ALL""")
SQL["negation_window"] = w(_WORDS, f"""
SELECT t.id, CAST(count(w) AS INTEGER) AS cues, CAST(count_if(coalesce(neg, false)) AS INTEGER) AS negated
FROM tok t LEFT JOIN flag f ON f.id = t.id AND f.w IN ({q(CUE_WORDS)}) GROUP BY t.id""")
SQL["dept_cue_profile"] = w(DEPS, "SELECT id, " + ", ".join(
    f"CAST(s_{k} AS INTEGER) AS score_{k}, array_to_string(m_{k}, ',') AS match_{k}" for k in ("rec", "hk", "fb")
) + " FROM dps")

# --- runtime layer
SQL["scored_predictions"] = w(SCORED, """
SELECT id, pd AS pred_department, ps0 AS pred_sentiment, round(dc, 6) AS department_confidence,
  round(greatest(p_neg0, p_pos0), 6) AS sentiment_confidence, round(p_rec, 6) AS p_rec, round(p_hk, 6) AS p_hk, round(p_fb, 6) AS p_fb
FROM scored""")
SQL["guardrail_override"] = w(GUARD, """
SELECT id, ps AS pred_sentiment, round(p_neg, 6) AS proba_sentiment_neg, round(p_pos, 6) AS proba_sentiment_pos,
  round(sc, 6) AS sentiment_confidence, applied AS sentiment_guardrail_applied,
  CAST(neg_s AS INTEGER) AS sentiment_guardrail_score, CAST(haz_s AS INTEGER) AS sentiment_hazard_score,
  haz_s >= 2 AS sentiment_hazard_flag, why AS sentiment_guardrail_reason FROM guard""")
SQL["impacted_department_lists"] = w(IMPACT, """
SELECT id, deps AS impacted_departments, CAST(n_deps AS INTEGER) AS impacted_departments_count,
  dep_why AS impacted_departments_reason, n_deps > 1 AS cross_department_signal FROM imp""")
SQL["review_flags"] = w(RISK, "SELECT id, review AS needs_review_diag FROM risk")
SQL["review_flags_from_table"] = w(SCORED + """
, thr AS (SELECT pd, avg(dc) AS t FROM scored GROUP BY pd)""", "SELECT id, dc < t AS below FROM scored JOIN thr USING (pd)")
SQL["risk_priority"] = w(RISK, "SELECT id, round(risk, 6) AS risk_score, priority FROM risk")
SQL["risk_without_runtime_columns"] = w(SCORED + f"""
, r AS (SELECT id, {d(0.62)} * CASE ps0 WHEN 'neg' THEN {d(0.70)} ELSE {d(0.30)} END + {d(0.24)} * (1 - dc)
  + {d(0.14)} * (1 - greatest(p_neg0, p_pos0)) AS risk FROM scored)""", f"""
SELECT id, false AS needs_review_diag, round(risk, 6) AS risk_score, CASE WHEN risk >= {d(0.78)} THEN 'URGENT' WHEN risk >= {d(0.58)} THEN 'HIGH'
  WHEN risk >= {d(0.38)} THEN 'MEDIUM' ELSE 'LOW' END AS priority FROM r""")
SQL["presentation_labels"] = w(RISK, f"""
SELECT id AS "{HEADINGS['id']}", pd AS "{HEADINGS['pred_department']}",
  CASE priority WHEN 'LOW' THEN 'BASSA' WHEN 'MEDIUM' THEN 'MEDIA' WHEN 'HIGH' THEN 'ALTA' ELSE 'URGENTE' END AS "{HEADINGS['priority']}",
  CASE WHEN review THEN 'SÌ' ELSE 'NO' END AS "{HEADINGS['needs_review_diag']}",
  CASE WHEN applied THEN 'SÌ' ELSE 'NO' END AS "{HEADINGS['sentiment_guardrail_applied']}",
  replace(deps, '|', ', ') AS "{HEADINGS['impacted_departments']}",
  replace(replace(dep_why, ':model', ':modello'), ';', ' | ') AS "{HEADINGS['impacted_departments_reason']}",
  round(p_neg, 6) AS "Probabilità sentiment neg" FROM risk""")

# --- roll-ups
SQL["sla_rollup"] = w(RISK + sla_sql("risk", "pd", "priority IN ('URGENT', 'HIGH')", SLA_ROWS, 8), "")
SQL["sla_rollup_orders"] = w("one AS (SELECT 1)" + sla_sql(
    "orders", "o_orderstatus", "o_orderpriority IN ('1-URGENT', '2-HIGH')",
    (("O", 2.0, 14.0), ("F", 4.0, 10.0), ("P", 6.0, 8.0), ("X", 4.0, 8.0)), 400), "")
SQL["sla_rollup_by_source"] = w(RISK + f"""
, dl(department, sla, cap) AS (VALUES ('Reception', {d(2.0)}, {d(14.0)}), ('Housekeeping', {d(4.0)}, {d(10.0)}), ('F&B', {d(6.0)}, {d(8.0)})),
g AS (SELECT s.source, dl.department, cap, count(r.id) AS volume, count_if(r.priority IN ('URGENT', 'HIGH')) AS urg
  FROM (SELECT DISTINCT source FROM risk) s CROSS JOIN dl LEFT JOIN risk r ON r.source = s.source AND r.pd = dl.department GROUP BY ALL)""", f"""
SELECT source, department, volume, greatest(volume - CAST(cap AS BIGINT), 0) AS backlog_estimated,
  round(least(greatest(1 - greatest(volume / cap - 1, 0) * {d(0.55)} - CASE WHEN volume > 0 THEN urg / volume ELSE 0 END * {d(0.12)}, 0), 1), 6) AS estimated_sla_hit_rate FROM g""")
SQL["priority_distribution"] = w(RISK, """
SELECT priority, count(*) AS rows, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM risk GROUP BY priority""")
SQL["order_priority_distribution"] = """
SELECT o_orderstatus, o_orderpriority, count(*) AS rows, round(count(*) / sum(count(*)) OVER (PARTITION BY o_orderstatus), 6) AS share
FROM orders GROUP BY o_orderstatus, o_orderpriority"""
SQL["coverage_review_rate"] = w(RISK, """
SELECT lang, count(*) AS rows, round(1 - avg(CAST(review AS INTEGER)), 6) AS coverage, round(avg(CAST(review AS INTEGER)), 6) AS needs_review_rate
FROM risk GROUP BY lang""")
SQL["guardrail_rate"] = w(GUARD, "SELECT round(avg(CAST(applied AS INTEGER)), 6) AS rate FROM guard")
SQL["batch_kpis"] = w(RISK, """
SELECT count(*) AS rows, CAST(count_if(priority IN ('HIGH', 'URGENT')) AS BIGINT) AS high_priority_rows,
  round(count_if(priority IN ('HIGH', 'URGENT')) / greatest(count(*), 1), 6) AS high_priority_share, round(avg(risk), 6) AS mean_risk,
  CAST(count_if(applied) AS BIGINT) AS guardrail_rows, round(count_if(applied) / greatest(count(*), 1), 6) AS guardrail_share,
  CAST(count_if(haz_s >= 2) AS BIGINT) AS hazard_rows, round(count_if(haz_s >= 2) / greatest(count(*), 1), 6) AS hazard_share,
  CAST(count_if(review) AS BIGINT) AS review_rows, round(count_if(review) / greatest(count(*), 1), 6) AS review_share FROM risk""")
_LABELLED = "l AS (SELECT doc_id AS id, lang AS department, CASE WHEN toxic = 1 THEN 'neg' ELSE 'pos' END AS sentiment, lang || '__' || CASE WHEN toxic = 1 THEN 'neg' ELSE 'pos' END AS stratum, text FROM documents JOIN labels USING (doc_id))"
SQL["dataset_profile"] = w(_LABELLED, """
SELECT 'rows' AS dimension, 'all' AS value, count(*) AS rows FROM l
UNION ALL SELECT 'department', department, count(*) FROM l GROUP BY department
UNION ALL SELECT 'sentiment', sentiment, count(*) FROM l GROUP BY sentiment""")
SQL["event_profile"] = """
SELECT 'rows' AS dimension, 'all' AS value, count(*) AS rows FROM events
UNION ALL SELECT 'event_type', event_type, count(*) FROM events GROUP BY event_type"""

# --- evaluation
SQL["confusion_matrix"] = w(EVAL, """
SELECT c.truth, CAST(count_if(pd = 'F&B') AS BIGINT) AS p_fb, CAST(count_if(pd = 'Housekeeping') AS BIGINT) AS p_hk, CAST(count_if(pd = 'Reception') AS BIGINT) AS p_rec
FROM (VALUES ('F&B'), ('Housekeeping'), ('Reception')) c(truth) LEFT JOIN ev ON td = c.truth GROUP BY c.truth""")
SQL["classification_report"] = w(EVAL + class_report_sql("td", "pd", "ev"), """
SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM report""")
SQL["macro_f1"] = w(EVAL + class_report_sql("td", "pd", "ev"), """
SELECT CAST(sum(support) AS BIGINT) AS rows, round(sum(tp) / sum(support), 6) AS accuracy, round(avg(precision), 6) AS macro_precision,
  round(avg(recall), 6) AS macro_recall, round(avg(f1), 6) AS macro_f1, round(sum(precision * support) / sum(support), 6) AS weighted_precision,
  round(sum(recall * support) / sum(support), 6) AS weighted_recall, round(sum(f1 * support) / sum(support), 6) AS weighted_f1 FROM report""")
SQL["ece_bins"] = w(ROUTE + "," + ece_bins_sql("pred", "conf", "truth", "rmax"), """
SELECT CAST(bin AS INTEGER) AS bin, n, round(accuracy, 6) AS accuracy, round(confidence, 6) AS confidence FROM bin""")
SQL["ece_brier"] = w(ROUTE + """
, sect AS (SELECT *, CASE WHEN vec_id % 2 = 0 THEN 'even' ELSE 'odd' END AS section FROM rmax),
br AS (SELECT vec_id, sum((p - CASE WHEN c = truth THEN 1 ELSE 0 END) ** 2) AS b FROM route GROUP BY vec_id),
""" + ece_bins_sql("pred", "conf", "truth", "sect", "section"), """
SELECT section, round(sum(abs(accuracy - confidence) * n) / sum(n), 6) AS ece,
  (SELECT round(avg(b), 6) FROM br JOIN sect s USING (vec_id) WHERE s.section = bin.section) AS brier
FROM bin GROUP BY section""")
SQL["class_threshold_table"] = w(ROUTE + f"""
, tq AS (SELECT truth, quantile_cont(p, 0.08) AS qv FROM route WHERE c = truth GROUP BY truth),
per AS (SELECT c AS class, coalesce(least(greatest(qv, {d(0.05)}), {d(0.90)}), {d(0.05)}) AS threshold
  FROM (VALUES ('0'), ('1'), ('2'), ('3'), ('4'), ('5'), ('6'), ('7'), ('8'), ('9'), ('none')) v(c) LEFT JOIN tq ON truth = c)""", f"""
SELECT class, round(threshold, 6) AS threshold FROM per
UNION ALL SELECT 'default', round(least(greatest(avg(threshold), {d(0.05)}), {d(0.90)}), 6) FROM per""")
SQL["exact_quantiles"] = """
SELECT o_orderstatus, count(*) AS group_rows, round(quantile_cont(o_totalprice / 600000, 0.08), 6) AS quantile FROM orders GROUP BY o_orderstatus"""
SQL["threshold_map"] = """
WITH r AS (SELECT lang AS class, CASE WHEN lang = 'fr' THEN 0.55 ELSE count(*) / 1000 END AS threshold FROM documents GROUP BY lang)
SELECT class, round(CAST(threshold AS DOUBLE), 6) AS threshold FROM r UNION ALL SELECT 'default', CAST(0.55 AS DOUBLE)"""

_TASKS = """
, pr AS (SELECT section, 'department' AS task, td AS truth, pd AS pred FROM ev UNION ALL SELECT section, 'sentiment', ts, ps FROM ev),
cls AS (SELECT section, task, truth AS class FROM pr UNION SELECT section, task, pred FROM pr),
cnt AS (SELECT c.section, c.task, c.class, count_if(truth = class AND pred = class) AS tp, count_if(truth = class) AS support,
  count_if(pred = class) AS predicted FROM cls c JOIN pr USING (section, task) GROUP BY ALL),
rp AS (SELECT section, task, class, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0 END AS precision,
  CASE WHEN support > 0 THEN tp / support ELSE 0 END AS recall,
  CASE WHEN support + predicted > 0 THEN 2 * tp / (support + predicted) ELSE 0 END AS f1, support, tp FROM cnt),
cal AS (
  SELECT section, 'department' AS task, td AS truth, pd AS label, dc AS conf,
    (p_fb - CAST(td = 'F&B' AS INTEGER)) ** 2 + (p_hk - CAST(td = 'Housekeeping' AS INTEGER)) ** 2 + (p_rec - CAST(td = 'Reception' AS INTEGER)) ** 2 AS b FROM ev
  UNION ALL SELECT section, 'sentiment', ts, ps0, greatest(p_neg0, p_pos0),
    (p_neg0 - CAST(ts = 'neg' AS INTEGER)) ** 2 + (p_pos0 - CAST(ts = 'pos' AS INTEGER)) ** 2 FROM ev),
""" + ece_bins_sql("label", "conf", "truth", "cal", "section, task")
_LONG = """
SELECT section, '' AS task, '' AS class, 'rows' AS metric, CAST(count(*) AS DOUBLE) AS value FROM ev GROUP BY section
UNION ALL SELECT section, task, class, 'precision', round(precision, 6) FROM rp
UNION ALL SELECT section, task, class, 'recall', round(recall, 6) FROM rp
UNION ALL SELECT section, task, class, 'f1', round(f1, 6) FROM rp
UNION ALL SELECT section, task, class, 'support', CAST(support AS DOUBLE) FROM rp
UNION ALL SELECT section, task, '', 'accuracy', round(sum(tp) / sum(support), 6) FROM rp GROUP BY ALL
UNION ALL SELECT section, task, '', 'f1_macro', round(avg(f1), 6) FROM rp GROUP BY ALL
UNION ALL SELECT section, task, '', 'ece', round(sum(abs(accuracy - confidence) * n) / sum(n), 6) FROM bin GROUP BY ALL
UNION ALL SELECT section, task, '', 'brier', round(avg(b), 6) FROM cal GROUP BY ALL
UNION ALL SELECT section, '', '', 'coverage', round(1 - avg(CAST(review AS INTEGER)), 6) FROM ev GROUP BY section
UNION ALL SELECT section, '', '', 'needs_review_rate', round(avg(CAST(review AS INTEGER)), 6) FROM ev GROUP BY section
UNION ALL SELECT section, '', priority, 'priority_share', round(count(*) / sum(count(*)) OVER (PARTITION BY section), 6) FROM ev GROUP BY section, priority"""
SQL["section_eval"] = w(EVAL + _TASKS, _LONG)

_SENT = """
, mp AS (SELECT section, source, 'plain' AS model, ts AS truth, ps0 AS pred FROM ev UNION ALL SELECT section, source, 'guarded', ts, ps FROM ev),
mc AS (SELECT section, model, truth AS class FROM mp UNION SELECT section, model, pred FROM mp),
mr AS (SELECT section, model, class, count_if(truth = class AND pred = class) AS tp, count_if(truth = class) AS support,
  count_if(pred = class) AS predicted FROM mc JOIN mp USING (section, model) GROUP BY ALL),
mf AS (SELECT section, model, class, CASE WHEN support > 0 THEN tp / support ELSE 0 END AS recall,
  CASE WHEN support + predicted > 0 THEN 2 * tp / (support + predicted) ELSE 0 END AS f1 FROM mr),
ms AS (SELECT section, model, avg(f1) AS f1, max(recall) FILTER (WHERE class = 'neg') AS rn, max(recall) FILTER (WHERE class = 'pos') AS rp
  FROM mf GROUP BY section, model)
"""
SQL["model_compare"] = w(EVAL + _SENT, """
SELECT section, 'sentiment' AS task, round(max(f1) FILTER (WHERE model = 'plain'), 6) AS plain, round(max(f1) FILTER (WHERE model = 'guarded'), 6) AS guarded,
  round(max(f1) FILTER (WHERE model = 'guarded') - max(f1) FILTER (WHERE model = 'plain'), 6) AS delta FROM ms GROUP BY section""")
_DELTA = _TASKS + _SENT + """
, dep_f1 AS (SELECT section, avg(f1) AS f1 FROM rp WHERE task = 'department' GROUP BY section),
rev_rate AS (SELECT section, avg(CAST(review AS INTEGER)) AS r FROM ev GROUP BY section),
sec(section) AS (VALUES ('quality'), ('other'), ('absent')),
both_runs AS (SELECT s.section, a.f1 AS a_f1, b.f1 AS b_f1, a.rn AS a_rn, b.rn AS b_rn, a.rp AS a_rp, b.rp AS b_rp, dep_f1.f1 AS df, r.r AS rr
  FROM sec s LEFT JOIN ms a ON a.section = s.section AND a.model = 'guarded' LEFT JOIN ms b ON b.section = s.section AND b.model = 'plain'
  LEFT JOIN dep_f1 ON dep_f1.section = s.section LEFT JOIN rev_rate r ON r.section = s.section),
cell AS (
  SELECT section, 'department_f1' AS metric, coalesce(df, 0) AS before, coalesce(df, 0) AS after FROM both_runs
  UNION ALL SELECT section, 'sentiment_f1', coalesce(b_f1, 0), coalesce(a_f1, 0) FROM both_runs
  UNION ALL SELECT section, 'sentiment_recall_neg', coalesce(b_rn, 0), coalesce(a_rn, 0) FROM both_runs
  UNION ALL SELECT section, 'sentiment_recall_pos', coalesce(b_rp, 0), coalesce(a_rp, 0) FROM both_runs
  UNION ALL SELECT section, 'coverage', 1 - rr, 1 - rr FROM both_runs
  UNION ALL SELECT section, 'needs_review_rate', rr, rr FROM both_runs)
"""
SQL["metric_delta"] = w(EVAL + _DELTA, """
SELECT section, metric, round(before, 6) AS before, round(after, 6) AS after, round(after - before, 6) AS delta,
  round(100 * coalesce(after - before, 0), 6) AS delta_pp FROM cell""")
SQL["advanced_delta"] = w(EVAL + _DELTA, """
SELECT section, CAST(0 AS DOUBLE) AS department_f1_delta, round(a_f1 - b_f1, 6) AS sentiment_f1_delta,
  CAST(NULL AS DOUBLE) AS department_ece_delta, CAST(NULL AS DOUBLE) AS sentiment_ece_delta FROM both_runs WHERE section <> 'absent'""")
SQL["run_summary"] = w(EVAL + """
, pr AS (SELECT source, section, 'department' AS task, td AS truth, pd AS pred FROM ev UNION ALL SELECT source, section, 'sentiment', ts, ps FROM ev),
cls AS (SELECT source, section, task, truth AS class FROM pr UNION SELECT source, section, task, pred FROM pr),
cnt AS (SELECT source, section, task, class, count_if(truth = class AND pred = class) AS tp, count_if(truth = class) + count_if(pred = class) AS both_n
  FROM cls JOIN pr USING (source, section, task) GROUP BY ALL),
f AS (SELECT source, section, task, avg(2 * tp / both_n) AS f1 FROM cnt GROUP BY ALL)""", """
SELECT source, round(max(f1) FILTER (WHERE section = 'quality' AND task = 'department'), 6) AS test_department_f1,
  round(max(f1) FILTER (WHERE section = 'quality' AND task = 'sentiment'), 6) AS test_sentiment_f1,
  round(max(f1) FILTER (WHERE section = 'other' AND task = 'department'), 6) AS safety_department_f1,
  round(max(f1) FILTER (WHERE section = 'other' AND task = 'sentiment'), 6) AS safety_sentiment_f1 FROM f GROUP BY source""")


def split_sql(source: str, key: str, stratum: str, share: float, seed: int, tag: str = "0") -> str:
    """Stratified hold-out by lowest seeded md5; relation ``held<tag>`` has is_test."""
    return f"""
h{tag} AS (SELECT *, md5(CAST({key} AS VARCHAR) || '-{seed}') AS hx{tag}, {stratum} AS st{tag} FROM {source}),
c{tag} AS (SELECT st{tag} AS st, count(*) AS n FROM h{tag} GROUP BY ALL),
z{tag} AS (SELECT CAST(ceil(sum(n) * {d(share)}) AS BIGINT) AS size, sum(n) AS total FROM c{tag}),
f{tag} AS (SELECT st, n, n / total * size AS raw, CAST(floor(n / total * size) AS BIGINT) AS base, size FROM c{tag}, z{tag}),
k{tag} AS (SELECT st, base + CASE WHEN row_number() OVER (ORDER BY raw - base DESC, st) <= size - (SELECT sum(base) FROM f{tag}) THEN 1 ELSE 0 END AS quota FROM f{tag}),
held{tag} AS (SELECT h{tag}.*, row_number() OVER (PARTITION BY st{tag} ORDER BY hx{tag}, {key}) <= quota AS is_test FROM h{tag} JOIN k{tag} ON k{tag}.st = h{tag}.st{tag})
"""


_runs = ", ".join(split_sql("rmax", "vec_id", "truth", 0.20, s, str(s)).strip() for s in (13, 21, 34, 42, 55))
_accs = " UNION ALL ".join(f"SELECT avg(CAST(pred = truth AS INTEGER)) AS a FROM held{s} WHERE is_test" for s in (13, 21, 34, 42, 55))
SQL["seed_summary"] = w(ROUTE + "," + _runs, f"""
SELECT 'accuracy' AS metric, round(avg(a), 6) AS mean, round(stddev_pop(a), 6) AS std, round(min(a), 6) AS min, round(max(a), 6) AS max, count(*) AS runs
FROM ({_accs})""")


def fold_sql(key: str, stratum: str, k: int, seed: int) -> str:
    return f"CAST((row_number() OVER (PARTITION BY {stratum} ORDER BY md5(CAST({key} AS VARCHAR) || '-{seed}'), {key}) - 1) % {k} AS INTEGER)"


SQL["fold_summary"] = w(ROUTE + f"""
, fl AS (SELECT {fold_sql('vec_id', 'truth', 5, 42)} AS fold, CAST(pred = truth AS INTEGER) AS ok FROM rmax),
fa AS (SELECT fold, round(avg(ok), 6) AS a FROM fl GROUP BY fold)""", """
SELECT round(avg(a), 6) AS mean, round(stddev_pop(a), 6) AS std, string_agg(printf('%.6f', a), ',' ORDER BY fold) AS folds FROM fa""")
SQL["calibration_choice"] = w(ROUTE + """
, pw AS (SELECT vec_id, truth, c, p AS u, 'plain' AS method FROM route UNION ALL SELECT vec_id, truth, c, p * p, 'sharp' FROM route),
pn AS (SELECT *, u / sum(u) OVER (PARTITION BY method, vec_id) AS pp FROM pw),
pm AS (SELECT method, vec_id, any_value(truth) AS truth, max(pp) AS conf, arg_max(c, pp) AS pred,
  sum((pp - CASE WHEN c = truth THEN 1 ELSE 0 END) ** 2) AS b FROM pn GROUP BY ALL),
""" + ece_bins_sql("pred", "conf", "truth", "pm", "method") + """
, res AS (SELECT e.method, ece, brier, accuracy FROM (SELECT method, sum(abs(accuracy - confidence) * n) / sum(n) AS ece FROM bin GROUP BY method) e
  JOIN (SELECT method, avg(b) AS brier, avg(CAST(pred = truth AS INTEGER)) AS accuracy FROM pm GROUP BY method) m USING (method))""", """
SELECT method, round(ece, 6) AS ece, round(brier, 6) AS brier, round(accuracy, 6) AS accuracy,
  method = (SELECT method FROM res ORDER BY ece, brier, -accuracy, method LIMIT 1) AS chosen FROM res""")

# --- conformal
SQL["conformal_scores"] = w(ROUTE, """
SELECT r.vec_id, round(score, 6) AS conformal_score, round(1 - r.p, 6) AS threshold_score FROM route r JOIN aps USING (vec_id) WHERE r.c = r.truth""")
_THR = ", thr_s AS (SELECT vec_id, 1 - p AS score FROM route WHERE c = truth)"
SQL["conformal_qhat"] = (
    "SELECT 'aps' AS method, CAST(0.1 AS DOUBLE) AS alpha, n, round(qhat, 6) AS qhat, CAST(NULL AS DOUBLE) AS threshold FROM ("
    + w(ROUTE + "," + qhat_sql("aps"), "SELECT qhat, n FROM qhat")
    + ") UNION ALL SELECT 'threshold', CAST(0.1 AS DOUBLE), n, round(qhat, 6), round(1 - qhat, 6) FROM ("
    + w(ROUTE + _THR + "," + qhat_sql("thr_s"), "SELECT qhat, n FROM qhat") + ")"
)
_APS_SETS = ROUTE + "," + qhat_sql("aps") + """
, keep AS (SELECT vec_id, least(count_if(mass < qhat) + 1, 10) AS k FROM ranked, qhat GROUP BY vec_id),
sets AS (SELECT r.vec_id, any_value(truth) AS truth, string_agg(c, '|' ORDER BY r) AS members, count(*) AS size, bool_or(c = truth) AS hit
  FROM ranked r JOIN keep USING (vec_id) WHERE r.r <= k GROUP BY r.vec_id)"""
SQL["conformal_sets_aps"] = w(_APS_SETS, "SELECT vec_id, members, CAST(size AS INTEGER) AS route_conformal_size FROM sets")
SQL["conformal_sets_threshold"] = w(ROUTE + _THR + "," + qhat_sql("thr_s") + """
, ins AS (SELECT vec_id, string_agg(c, '|' ORDER BY c) AS m, count(*) AS n FROM route, qhat q WHERE p >= 1 - qhat GROUP BY vec_id)""", """
SELECT vec_id, coalesce(m, pred) AS members, CAST(coalesce(ins.n, 1) AS INTEGER) AS route_conformal_size FROM rmax LEFT JOIN ins USING (vec_id)""")
SQL["conformal_eval"] = w(_APS_SETS, """
SELECT truth, count(*) AS rows, round(avg(CAST(hit AS INTEGER)), 6) AS coverage, round(avg(size), 6) AS avg_set_size FROM sets GROUP BY truth""")

# --- splits and set operations
SQL["stratified_split"] = w(_LABELLED + "," + split_sql("l", "id", "stratum", 0.20, 42), "SELECT id, is_test FROM held0")
SQL["stratified_split_orders"] = w(split_sql("orders", "o_orderkey", "o_orderstatus || '__' || o_orderpriority", 0.2, 7), "SELECT o_orderkey FROM held0 WHERE is_test")
SQL["three_way_split"] = w(
    _LABELLED + "," + split_sql("l", "id", "stratum", 0.20, 42, "1")
    + ", rest AS (SELECT id, stratum FROM held1 WHERE NOT is_test)," + split_sql("rest", "id", "stratum", 0.20, 43, "2"), """
SELECT id, 'test' AS split FROM held1 WHERE is_test UNION ALL SELECT id, CASE WHEN is_test THEN 'calibration' ELSE 'train' END FROM held2""")
SQL["stratified_kfold"] = w(_LABELLED, f"SELECT id, {fold_sql('id', 'stratum', 5, 42)} AS fold FROM l")
SQL["stratified_kfold_lineitem"] = w(f"""
x AS (SELECT l_returnflag, l_orderkey || '-' || l_linenumber AS k FROM lineitem),
y AS (SELECT l_returnflag, k, {fold_sql('k', 'l_returnflag', 5, 3)} AS fold FROM x)""", """
SELECT k, fold FROM y""")
_QUOTA = "cg AS (SELECT department, sentiment, count(*) AS n FROM l GROUP BY ALL)," + quota_sql("cg", "{size}", "department, sentiment")
SQL["largest_remainder_quota"] = w(_LABELLED + "," + _QUOTA.format(size=50), """
SELECT department, sentiment, n AS rows, round(quota_raw, 6) AS quota_raw, quota FROM quo""")
_REPLAY = """
, rk AS (SELECT l.*, row_number() OVER (PARTITION BY l.department, l.sentiment ORDER BY md5(CAST(id AS VARCHAR) || '-42')) AS r FROM l),
rep AS (SELECT rk.* FROM rk JOIN quo USING (department, sentiment) WHERE r <= quota)
"""
SQL["replay_sample"] = w(_LABELLED + "," + _QUOTA.format(size=50) + _REPLAY, "SELECT id, department, sentiment FROM rep")
SQL["augment_union"] = w(_LABELLED, """
SELECT CAST(0 AS INTEGER) AS copy, id, department, sentiment FROM l
UNION ALL SELECT CAST(c AS INTEGER), id, department, sentiment FROM l, range(1, 3) t(c) WHERE sentiment = 'neg'""")
SQL["labelled_queue_rows"] = "SELECT conv_id * 1000 + turn AS id, role AS true_department FROM conversations WHERE turn % 2 <> 0"
SQL["append_labeled"] = w(_LABELLED + "," + _QUOTA.format(size=40) + _REPLAY + """
, top AS (SELECT max(id) + 1 AS nxt FROM l),
lab AS (SELECT nxt + row_number() OVER (ORDER BY conv_id * 1000 + turn) - 1 AS id, text FROM conversations, top),
base2 AS (SELECT max(id) + 1 AS nxt FROM lab)""", """
SELECT id, 'base' AS origin, department, sentiment, text AS body FROM l
UNION ALL SELECT id, 'labelled', 'en', 'pos', text FROM lab
UNION ALL SELECT nxt + row_number() OVER (ORDER BY id) - 1, 'replay', department, sentiment, text FROM rep, base2""")

# --- active learning
_GRAMS = "list_concat({t}, list_transform(range(1, greatest(len({t}), 1)), lambda i: {t}[i] || ' ' || {t}[i + 1]))"
SQL["tfidf_weights"] = w(f"""
b AS (SELECT item_id, list_filter(string_split({norm('text')}, ' '), lambda x: length(x) >= 2) AS t FROM benchmark),
g AS (SELECT item_id, unnest({_GRAMS.format(t='t')}) AS term FROM b),
tf AS (SELECT item_id, term, count(*) AS tf FROM g GROUP BY ALL),
n AS (SELECT count(*) AS n FROM benchmark),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
v AS (SELECT term, ln((n + 1) / (df + 1)) + 1 AS idf FROM df, n WHERE df >= 2 AND df <= n * {d(0.98)}),
x AS (SELECT item_id, term, (1 + ln(tf)) * idf AS w FROM tf JOIN v USING (term))""", """
SELECT item_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY item_id)), 6) AS weight FROM x""")
SQL["tfidf_vocabulary"] = w(TXT + f"""
, b AS (SELECT id, list_filter(tk, lambda x: length(x) >= 2) AS t FROM tok),
g AS (SELECT id, unnest({_GRAMS.format(t='t')}) AS term FROM b),
tf AS (SELECT id, term, count(*) AS tf FROM g GROUP BY ALL)""", """
SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS total_tf, round(ln(((SELECT count(*) FROM documents) + 1) / (count(*) + 1)) + 1, 6) AS idf
FROM tf GROUP BY term""")
_CHAR = TXT + f"""
, cg AS (SELECT id, unnest({char_grams_sql('tk', 3, 5)}) AS term FROM tok),
ct AS (SELECT id, term, count(*) AS tf FROM cg GROUP BY ALL)
"""
SQL["char_ngrams"] = w(_CHAR, "SELECT term, CAST(sum(tf) AS BIGINT) AS total_tf, count(*) AS df FROM ct GROUP BY term")
_NOVEL = """
, voc AS (SELECT term, count(*) AS df FROM ct GROUP BY term),
idf AS (SELECT term, ln(((SELECT count(*) FROM documents) + 1) / (df + 1)) + 1 AS idf FROM voc),
wt AS (SELECT id, term, tf * idf AS w FROM ct JOIN idf USING (term)),
un AS (SELECT id, term, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS w FROM wt),
bs AS (SELECT un.* FROM un JOIN labels ON doc_id = id),
pl AS (SELECT un.* FROM un WHERE id NOT IN (SELECT doc_id FROM labels)),
dt AS (SELECT pl.id, bs.id AS base, sum(pl.w * bs.w) AS s FROM pl JOIN bs USING (term) GROUP BY ALL),
bst AS (SELECT id, max(s) AS s FROM dt GROUP BY id),
nov AS (SELECT t.id, least(greatest(1 - coalesce(s, 0), 0), 1) AS diversity FROM txt t LEFT JOIN bst USING (id) WHERE t.id NOT IN (SELECT doc_id FROM labels))
"""
SQL["novelty_max_cosine"] = w(_CHAR + _NOVEL, "SELECT id, round(diversity, 6) AS diversity_score FROM nov")
SQL["operational_cost"] = w(RISK, f"SELECT id, round({COST}, 6) AS business_cost_score FROM risk")
_ACQ = f"""
, acq AS (SELECT r.*, 1 - (0.5 * dc + 0.5 * sc) AS u, {COST} AS b, diversity FROM risk r JOIN nov USING (id)),
acq2 AS (SELECT *, {d(0.5)} * u + {d(0.3)} * diversity + {d(0.2)} * b AS a FROM acq),
queue AS (SELECT * FROM acq2 ORDER BY a DESC, u DESC, risk DESC, id LIMIT 60)
"""
_FULL = RISK + _CHAR[len(TXT):] + _NOVEL + _ACQ
SQL["acquisition_queue"] = w(_FULL, """
SELECT id, pd AS pred_department, priority, '' AS true_department, round(u, 6) AS uncertainty_score, round(diversity, 6) AS diversity_score,
  round(b, 6) AS business_cost_score, round(a, 6) AS acquisition_score, round(risk, 6) AS risk_score FROM queue""")
SQL["acquisition_queue_uncertainty"] = w(RISK, """
SELECT id, round(u, 6) AS acquisition_score, review AS needs_review_diag, '' AS reviewer_notes FROM (
  SELECT *, 1 - (0.5 * dc + 0.5 * sc) AS u FROM risk WHERE review AND id NOT IN (SELECT doc_id FROM labels)) ORDER BY u DESC, risk DESC, id LIMIT 40""")
SQL["queue_means"] = w(_FULL, """
SELECT count(*) AS rows, round(avg(u), 6) AS mean_uncertainty_score, round(avg(diversity), 6) AS mean_diversity_score,
  round(avg(b), 6) AS mean_business_cost_score, round(avg(a), 6) AS mean_acquisition_score FROM queue""")

# --- explanations
SQL["token_explanations"] = w(TXT + """
, g AS (SELECT id, lang, unnest(list_filter(tk, lambda x: length(x) >= 2)) AS term FROM tok),
tf AS (SELECT id, lang, term, count(*) AS tf FROM g GROUP BY ALL),
voc AS (SELECT term, count(*) AS df FROM tf GROUP BY term ),
idf AS (SELECT term, ln(((SELECT count(*) FROM documents) + 1) / (df + 1)) + 1 AS idf FROM voc),
wt AS (SELECT id, lang, term, (1 + ln(tf)) * idf AS w FROM tf JOIN idf USING (term)),
un AS (SELECT id, lang, term, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS w FROM wt),
pl AS (SELECT lang, term, sum(w) AS s FROM un GROUP BY ALL),
co AS (SELECT lang, term, round(s - sum(s) OVER (PARTITION BY term) / 4, 6) AS coef FROM pl),
v AS (SELECT id, term, round(w, 6) * coef AS v FROM un JOIN co USING (lang, term)),
a AS (SELECT *, bool_or(v > 0) OVER (PARTITION BY id) AS any_pos FROM v),
r AS (SELECT id, term, abs(v) AS contribution, row_number() OVER (PARTITION BY id ORDER BY abs(v) DESC, term) AS rank FROM a WHERE v > 0 OR NOT any_pos)""", """
SELECT id, CAST(rank AS INTEGER) AS rank, term, round(contribution, 6) AS contribution FROM r WHERE rank <= 5""")

# --- generation and noise
def draw_sql(key: str, salt: str) -> str:
    """Uniform draw from the first 32 bits of a seeded md5."""
    return f"(('0x' || substring(md5({key} || '-{salt}'), 1, 8))::BIGINT / {d(2.0**32)})"


def other_sql(value: str, values: tuple[str, ...], draw: str) -> str:
    cases = []
    for v in values:
        rest = [x for x in values if x != v]
        cases.append(f"WHEN '{v}' THEN ([{q(rest)}])[CAST(floor({draw} * {len(rest)}) AS INTEGER) + 1]")
    return f"CASE {value} {' '.join(cases)} END"


_DEPS3 = ("Housekeeping", "Reception", "F&B")
SQL["label_noise"] = w(f"""
x AS (SELECT l_orderkey || '-' || l_linenumber AS id, ([{q(_DEPS3)}])[l_linenumber % 3 + 1] AS dep,
  CASE WHEN l_returnflag = 'R' THEN 'neg' ELSE 'pos' END AS sent FROM lineitem),
y AS (SELECT id, CASE WHEN {draw_sql('id', '42-dep')} < {d(0.10)} THEN {other_sql('dep', _DEPS3, draw_sql('id', '42-dep_to'))} ELSE dep END AS department,
  CASE WHEN {draw_sql('id', '42-sent')} < {d(0.18)} THEN CASE sent WHEN 'pos' THEN 'neg' ELSE 'pos' END ELSE sent END AS sentiment FROM x)""", """
SELECT id, department, sentiment FROM y""")


def typo_sql(phrases, words, level: float) -> str:
    steps, prev = [], "rev"
    for i, (right, wrong) in enumerate(phrases):
        steps.append(f"""p{i} AS (SELECT id, CASE WHEN contains(body, '{right}') AND {draw_sql('CAST(id AS VARCHAR)', f'42-phrase{i}')} < {d(level)}
  THEN substring(body, 1, instr(body, '{right}') - 1) || '{wrong}' || substring(body, instr(body, '{right}') + {len(right)}) ELSE body END AS body FROM {prev})""")
        prev = f"p{i}"
    cases = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in words.items())
    return TXT.strip() + ", " + ",\n".join(steps) + f""",
sp AS (SELECT id, list_filter(regexp_split_to_array(body, '\\s+'), lambda x: x <> '') AS ws FROM {prev}),
ew AS (SELECT id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM sp),
bw AS (SELECT id, w, i, lower(trim(w, '.,;:!?')) AS b, CASE WHEN right(w, 1) IN ('.', ',', ';', ':', '!', '?') THEN right(w, 1) ELSE '' END AS tail FROM ew),
nw AS (SELECT id, i, CASE WHEN b IN ({q(list(words))}) AND {draw_sql("id || ':' || (i - 1)", '42-word')} < {d(level)} THEN CASE b {cases} END || tail ELSE w END AS w FROM bw),
jn AS (SELECT s.id, coalesce(string_agg(w, ' ' ORDER BY i), '') AS t FROM sp s LEFT JOIN nw USING (id) GROUP BY s.id)
SELECT id, CASE WHEN contains(t, ',') AND {draw_sql('CAST(id AS VARCHAR)', '42-comma')} < {d(level)}
  THEN substring(t, 1, instr(t, ',') - 1) || substring(t, instr(t, ',') + 1) ELSE t END AS body FROM jn"""


SQL["typo_noise"] = "WITH " + typo_sql(
    (("of the", "ofthe"), ("de la", "dela")), {"the": "teh", "with": "wiht", "les": "lse", "und": "udn"}, 0.3)

# --- trained models: what must hold whatever was fitted
SQL["ensemble_batch_scores"] = """
SELECT doc_id AS id, CAST(1 AS DOUBLE) AS mass, true AS confidence_is_largest, true AS prediction_is_largest, true AS doubtful_flagged FROM documents"""
SQL["fold_masks"] = w(TXT + f"""
, lab AS (SELECT tok.id, lang AS department, list_filter(tk, lambda x: length(x) >= 2) AS t FROM tok JOIN labels ON doc_id = tok.id),
fo AS (SELECT *, {fold_sql('id', 'department', 5, 42)} AS fold FROM lab),
g AS (SELECT DISTINCT id, fold, unnest({_GRAMS.format(t='t')}) AS term FROM fo),
h AS (SELECT unnest(range(0, 5)) AS h),
n AS (SELECT h, count(*) AS n FROM h JOIN fo ON fold <> h GROUP BY h),
df AS (SELECT h, term, count(*) AS df FROM h JOIN g ON fold <> h GROUP BY ALL)""", """
SELECT CAST(h AS INTEGER) AS fold, any_value(n) AS rows, count(*) AS terms, CAST(sum(df) AS BIGINT) AS occurrences
FROM df JOIN n USING (h) WHERE df >= 2 AND df <= n * CAST(0.98 AS DOUBLE) GROUP BY h""")

# --- windowed load on events
_WINDOWED = """
WITH dep(department, sla, per_hour) AS (VALUES ('click', 2.0::DOUBLE, 3.0::DOUBLE), ('error', 1.0, 2.0), ('purchase', 4.0, 2.5), ('signup', 4.0, 8.0), ('view', 6.0, 4.0)),
e AS (SELECT time_bucket(INTERVAL 8 HOUR, ts, TIMESTAMP '1970-01-01') AS win, event_type, coalesce(value > 30, false) AS urgent FROM events
  WHERE CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS INTEGER) <= 60 AND ts IS NOT NULL),
c AS (SELECT win, department, sla, per_hour * 8 AS cap, count(event_type) FILTER (WHERE event_type = department) AS volume,
  count_if(event_type = department AND urgent) AS urgent FROM e, dep GROUP BY ALL),
o AS (SELECT *, greatest(volume / cap - 1, 0) AS over, CASE WHEN volume > 0 THEN urgent / volume ELSE 0 END AS share FROM c)
SELECT strftime(win, '%Y-%m-%d %H:%M') AS window_start, department, volume, CAST(8 AS INTEGER) AS window_hours, CAST(floor(cap) AS BIGINT) AS capacity_tickets,
  greatest(volume - CAST(floor(cap) AS BIGINT), 0) AS backlog_estimated, sla AS sla_target_hours, round(sla * (1 + over * 1.75::DOUBLE), 6) AS estimated_avg_response_hours,
  round(least(greatest(1 - over * 0.55::DOUBLE - share * 0.12::DOUBLE, 0), 1), 6) AS estimated_sla_hit_rate FROM o"""
SQL["windowed_load_events"] = _WINDOWED
SQL["windowed_load_stream"] = _WINDOWED
