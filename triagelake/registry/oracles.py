"""SQL counterparts of the registered queries, for DuckDB on the same tables.

Written against the rules of the operators, not generated from the Spark code.
Doubles are rounded to six places on both sides.
"""

from __future__ import annotations

from collections.abc import Sequence

from ..plans.driver_tables import LEXICONS, POLARITY_WORDS

KEEP = "[^a-z0-9àèìòù]+"
ITALIAN_COSTS = {
    "department": ({"Reception": 0.95, "Housekeeping": 1.05, "F&B": 1.20}, 1.0),
    "sentiment": ({"pos": 0.45, "neg": 1.00}, 0.7),
    "priority": ({"LOW": 0.25, "MEDIUM": 0.55, "HIGH": 0.80, "URGENT": 1.00}, 0.5),
}


def q(values: Sequence[str]) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def d(x: float) -> str:
    return f"CAST({x!r} AS DOUBLE)"


def norm(expr: str) -> str:
    return f"trim(regexp_replace(lower(coalesce({expr}, '')), '{KEEP}', ' ', 'g'))"


def live(cues: Sequence[str]) -> str:
    neg = q(LEXICONS.negators)
    return (
        f"list_filter(tk, lambda w, i: w IN ({q(cues)}) "
        f"AND NOT coalesce(tk[i-1] IN ({neg}), false) AND NOT coalesce(tk[i-2] IN ({neg}), false))"
    )


def phrases(items: Sequence[str]) -> str:
    if not items:
        return "CAST([] AS VARCHAR[])"
    return f"list_filter([{q(sorted(items))}], lambda p: contains(text, p))"


TXT = f"""
rev AS (SELECT doc_id AS id, split_part(text, chr(10), 1) AS title, text AS body, lang, source FROM documents),
txt AS (SELECT id, lang, source, title, body,
  concat_ws(' ', nullif({norm('title')}, ''), nullif({norm('body')}, ''), nullif({norm('body')}, '')) AS text FROM rev),
tok AS (SELECT *, CASE WHEN text = '' THEN CAST([] AS VARCHAR[]) ELSE string_split(text, ' ') END AS tk FROM txt)
"""

CUES = TXT + f""",
cue AS (SELECT *,
  {live(LEXICONS.negative.cues)} AS neg_w, {phrases(LEXICONS.negative.phrases)} AS neg_p,
  {live(LEXICONS.hazard.cues)} AS haz_w, {phrases(LEXICONS.hazard.phrases)} AS haz_p,
  {live(LEXICONS.positive.cues)} AS pos_w, {phrases(LEXICONS.positive.phrases)} AS pos_p
  FROM tok),
sc AS (SELECT *, len(neg_w) + 2 * len(neg_p) AS neg_s, len(haz_w) + 2 * len(haz_p) AS haz_s,
  len(pos_w) + 2 * len(pos_p) AS pos_s FROM cue)
"""


def dep_key(name: str) -> str:
    return {"Reception": "rec", "Housekeeping": "hk", "F&B": "fb"}[name]


def dep_match(name: str) -> str:
    cues = LEXICONS.departments[name]
    single = [c for c in cues if " " not in c]
    multi = [c for c in cues if " " in c]
    return f"list_sort(list_concat(list_filter([{q(sorted(single))}], lambda c: list_contains(tk, c)), {phrases(multi)}))"


DEPS = CUES + ", dep AS (SELECT *, " + ", ".join(
    f"{dep_match(n)} AS m_{dep_key(n)}" for n in LEXICONS.departments
) + " FROM sc), dps AS (SELECT *, " + ", ".join(
    f"len(m_{k}) + len(list_filter(m_{k}, lambda c: contains(c, ' '))) AS s_{k}" for k in ("rec", "hk", "fb")
) + " FROM dep)"

SCORED = DEPS + f""",
prob AS (SELECT *,
  (1 + s_fb) / CAST(3 + s_rec + s_hk + s_fb AS DOUBLE) AS p_fb,
  (1 + s_hk) / CAST(3 + s_rec + s_hk + s_fb AS DOUBLE) AS p_hk,
  (1 + s_rec) / CAST(3 + s_rec + s_hk + s_fb AS DOUBLE) AS p_rec,
  len(list_filter(tk, lambda w: w IN ({q(POLARITY_WORDS['neg'])}))) AS n_neg,
  len(list_filter(tk, lambda w: w IN ({q(POLARITY_WORDS['pos'])}))) AS n_pos
  FROM dps),
scr AS (SELECT *,
  (1 + n_neg) / CAST(2 + n_neg + n_pos AS DOUBLE) AS p_neg0, (1 + n_pos) / CAST(2 + n_neg + n_pos AS DOUBLE) AS p_pos0,
  greatest(p_fb, p_hk, p_rec) AS dc,
  CASE WHEN p_fb >= p_hk AND p_fb >= p_rec THEN 'F&B' WHEN p_hk >= p_rec THEN 'Housekeeping' ELSE 'Reception' END AS pd
  FROM prob),
scored AS (SELECT *, CASE WHEN p_neg0 >= p_pos0 THEN 'neg' ELSE 'pos' END AS ps0 FROM scr)
"""

GUARD = SCORED + f""",
tgt AS (SELECT *,
  CASE WHEN ps0 = 'pos' AND haz_s >= 1 THEN CASE haz_s WHEN 1 THEN {d(0.78)} WHEN 2 THEN {d(0.90)} ELSE {d(0.95)} END
       WHEN ps0 = 'pos' AND neg_s >= 2 THEN CASE neg_s WHEN 2 THEN {d(0.68)} ELSE {d(0.82)} END END AS t_neg,
  CASE WHEN ps0 = 'neg' AND haz_s = 0 AND neg_s = 0 AND pos_s >= 3
       THEN CASE pos_s WHEN 3 THEN {d(0.74)} ELSE {d(0.86)} END END AS t_pos
  FROM scored),
grd AS (SELECT *,
  coalesce(p_neg0 < t_neg, false) OR coalesce(p_pos0 < t_pos, false) AS applied,
  CASE WHEN p_neg0 < t_neg THEN t_neg WHEN p_pos0 < t_pos THEN 1 - t_pos ELSE p_neg0 END AS p_neg,
  CASE WHEN p_neg0 < t_neg THEN 1 - t_neg WHEN p_pos0 < t_pos THEN t_pos ELSE p_pos0 END AS p_pos
  FROM tgt),
guard AS (SELECT *, CASE WHEN p_neg >= p_pos THEN 'neg' ELSE 'pos' END AS ps, greatest(p_neg, p_pos) AS sc,
  array_to_string(list_slice(list_concat(
    list_slice(list_concat(list_transform(haz_p, lambda x: 'hazard_bigram:' || x), list_transform(haz_w, lambda x: 'hazard_cue:' || x)), 1, 3),
    list_concat(
    list_slice(list_concat(list_transform(neg_p, lambda x: 'bigram:' || x), list_transform(neg_w, lambda x: 'cue:' || x)), 1, 3),
    list_slice(list_concat(list_transform(pos_p, lambda x: 'pos_bigram:' || x), list_transform(pos_w, lambda x: 'pos_cue:' || x)), 1, 3))
  ), 1, 5), ';') AS why
  FROM grd)
"""

# departments as rows, ranked by window functions (the Spark side sorts an array inside the row)
IMPACT = GUARD + """,
long AS (
  SELECT id, pd, 'F&B' AS c, s_fb AS s, p_fb AS p, m_fb AS m FROM guard UNION ALL
  SELECT id, pd, 'Housekeeping', s_hk, p_hk, m_hk FROM guard UNION ALL
  SELECT id, pd, 'Reception', s_rec, p_rec, m_rec FROM guard),
pick AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY s DESC, p DESC, c DESC) AS r
  FROM long WHERE c = pd OR s >= 2 OR p >= CAST(0.28 AS DOUBLE)),
imp AS (SELECT id, string_agg(c, '|' ORDER BY r) AS deps, count(*) AS n_deps,
  string_agg(CASE WHEN s > 0 THEN c || ':' || s || '[' || array_to_string(list_slice(m, 1, 3), ',') || ']' ELSE c || ':model' END, ';' ORDER BY r)
    FILTER (WHERE r <= 3) AS dep_why
  FROM pick GROUP BY id)
"""

RISK = IMPACT + f""",
opr AS (SELECT guard.*, deps, n_deps, dep_why,
  dc < CASE pd WHEN 'F&B' THEN {d(0.50)} ELSE {d(0.45)} END OR sc < CASE ps WHEN 'neg' THEN {d(0.65)} ELSE {d(0.60)} END AS review
  FROM guard JOIN imp USING (id)),
rsk0 AS (SELECT *, least(greatest({d(0.62)} * p_neg + {d(0.24)} * (1 - dc) + {d(0.14)} * (1 - sc)
    + CASE WHEN review THEN {d(0.05)} ELSE 0 END + CASE WHEN n_deps > 1 THEN {d(0.04)} ELSE 0 END
    + least({d(0.24)}, {d(0.06)} * haz_s), 0), 1) AS r0 FROM opr),
rsk1 AS (SELECT *, CASE WHEN haz_s >= 2 THEN greatest(r0, {d(0.58)}) ELSE r0 END AS risk FROM rsk0),
risk AS (SELECT *, CASE WHEN risk >= {d(0.78)} THEN 'URGENT' WHEN risk >= {d(0.58)} THEN 'HIGH'
  WHEN risk >= {d(0.38)} THEN 'MEDIUM' ELSE 'LOW' END AS priority FROM rsk1)
"""


def sla_sql(source: str, department: str, urgent: str, rows: Sequence[tuple[str, float, float]], hours: float) -> str:
    """Load roll-up over a source; rows are (department, sla hours, capacity per hour)."""
    values = ", ".join(f"('{n}', {d(s)}, {d(c)})" for n, s, c in rows)
    return f"""
, dep_list(department, sla, per_hour) AS (VALUES {values}),
load AS (SELECT dl.department, sla, per_hour * {d(hours)} AS cap, count({department}) AS volume,
    count_if({urgent}) AS urg
  FROM dep_list dl LEFT JOIN {source} s ON s.{department} = dl.department GROUP BY ALL),
load2 AS (SELECT *, greatest(CASE WHEN cap > 0 THEN volume / cap ELSE 1 END - 1, 0) AS over,
    CASE WHEN volume > 0 THEN urg / volume ELSE 0 END AS share FROM load)
SELECT department, volume, CAST({int(hours)} AS INTEGER) AS window_hours, CAST(floor(cap) AS BIGINT) AS capacity_tickets,
  greatest(volume - CAST(floor(cap) AS BIGINT), 0) AS backlog_estimated, sla AS sla_target_hours,
  round(sla * (1 + over * 1.75), 6) AS estimated_avg_response_hours,
  round(least(greatest(1 - over * {d(0.55)} - share * {d(0.12)}, 0), 1), 6) AS estimated_sla_hit_rate
FROM load2"""


SLA_ROWS = (("Reception", 2.0, 14.0), ("Housekeeping", 4.0, 10.0), ("F&B", 6.0, 8.0))

# labelled, scored rows for the evaluation queries
EVAL = RISK + """,
ev AS (SELECT r.*, CASE WHEN l.toxic = 1 THEN 'neg' ELSE 'pos' END AS ts, l.quality,
  CASE r.lang WHEN 'en' THEN 'Reception' WHEN 'de' THEN 'F&B' ELSE 'Housekeeping' END AS td,
  CASE WHEN l.quality = 1 THEN 'quality' ELSE 'other' END AS section
  FROM risk r JOIN labels l ON l.doc_id = r.id)
"""

# embeddings -> class centroids -> dot products -> softmax, as rows (id, truth, class, p)
ROUTE = """
cells AS (SELECT vec_id, CAST(label AS VARCHAR) AS truth, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
cen AS (SELECT truth AS c, i, avg(CAST(x AS DOUBLE)) AS m FROM cells GROUP BY ALL),
dots AS (SELECT vec_id, truth, c, exp(20 * sum(CAST(x AS DOUBLE) * m)) AS e FROM cells JOIN cen USING (i) GROUP BY ALL),
route AS (SELECT vec_id, truth, c, round(e / sum(e) OVER (PARTITION BY vec_id), 9) AS p FROM dots),
rmax AS (SELECT vec_id, any_value(truth) AS truth, max(p) AS conf, min(c) FILTER (WHERE p = mx) AS pred
  FROM (SELECT *, max(p) OVER (PARTITION BY vec_id) AS mx FROM route) GROUP BY vec_id),
ranked AS (SELECT *, row_number() OVER w AS r, sum(p) OVER w AS mass FROM route
  WINDOW w AS (PARTITION BY vec_id ORDER BY p DESC, c ROWS UNBOUNDED PRECEDING)),
aps AS (SELECT vec_id, truth, mass AS score FROM ranked WHERE c = truth)
"""


def qhat_sql(source: str, alpha: float = 0.10) -> str:
    """Order statistic of the calibration scores."""
    return f"""
qn AS (SELECT count(*) AS n FROM {source}),
qr AS (SELECT n, ceil(least(greatest(ceil((n + 1) * {d(1.0 - alpha)}) / n, 0), 1) * (n - 1)) AS rank FROM qn),
qhat AS (SELECT score AS qhat, n FROM (SELECT score, row_number() OVER (ORDER BY score) - 1 AS i FROM {source}), qr WHERE i = rank)
"""


def class_report_sql(truth: str, pred: str, source: str) -> str:
    return f"""
, names AS (SELECT {truth} AS class FROM {source} UNION SELECT {pred} FROM {source}),
rep AS (SELECT class, CAST(count_if({truth} = class AND {pred} = class) AS BIGINT) AS tp, CAST(count_if({truth} = class) AS BIGINT) AS support,
  CAST(count_if({pred} = class) AS BIGINT) AS predicted FROM names, {source} GROUP BY class),
report AS (SELECT class, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0 END AS precision,
  CASE WHEN support > 0 THEN tp / support ELSE 0 END AS recall,
  CASE WHEN support + predicted > 0 THEN 2 * tp / (support + predicted) ELSE 0 END AS f1, support, tp FROM rep)
"""


def ece_bins_sql(label: str, conf: str, truth: str, source: str, keys: str = "") -> str:
    """Occupied bins; edges b * (1/15) in double arithmetic."""
    k = keys + ", " if keys else ""
    edges = " + ".join(f"CAST({conf} >= {b} * (CAST(1 AS DOUBLE) / 15) AS INTEGER)" for b in range(1, 15))
    return f"""
bins AS (SELECT {k}{edges} AS bin, CAST({label} = {truth} AS INTEGER) AS hit, {conf} AS conf FROM {source}),
bin AS (SELECT {k}bin, count(*) AS n, avg(hit) AS accuracy, avg(conf) AS confidence FROM bins GROUP BY ALL)
"""


def quota_sql(counts: str, size: str, keys: str, count: str = "n") -> str:
    """Largest remainder over a counts relation."""
    return f"""
tot AS (SELECT CAST(sum({count}) AS BIGINT) AS total FROM {counts}),
raw AS (SELECT c.*, {count} / CAST(total AS DOUBLE) * ({size}) AS quota_raw FROM {counts} c, tot),
flo AS (SELECT *, CAST(floor(quota_raw) AS BIGINT) AS base FROM raw),
quo AS (SELECT *, base + CASE WHEN row_number() OVER (ORDER BY quota_raw - base DESC, {keys})
   <= ({size}) - (SELECT CAST(sum(base) AS BIGINT) FROM flo) THEN 1 ELSE 0 END AS quota FROM flo, (SELECT 1) )
"""


COST = "least(greatest({w}, 0), 1)".format(w=" + ".join([
    "0.45::DOUBLE * CASE ps WHEN 'pos' THEN 0.45::DOUBLE WHEN 'neg' THEN 1.00::DOUBLE ELSE 0.7::DOUBLE END",
    "0.30::DOUBLE * CASE priority WHEN 'LOW' THEN 0.25::DOUBLE WHEN 'MEDIUM' THEN 0.55::DOUBLE WHEN 'HIGH' THEN 0.80::DOUBLE WHEN 'URGENT' THEN 1.00::DOUBLE ELSE 0.5::DOUBLE END",
    "0.15::DOUBLE * CASE pd WHEN 'Reception' THEN 0.95::DOUBLE WHEN 'Housekeeping' THEN 1.05::DOUBLE WHEN 'F&B' THEN 1.20::DOUBLE ELSE 1.0::DOUBLE END",
    "0.10::DOUBLE * least(greatest(risk, 0), 1)",
]))


def char_grams_sql(words: str, low: int, high: int) -> str:
    """Padded-word character n-grams of a word list; a short word gives itself once."""
    return (
        f"flatten(list_transform({words}, lambda w: flatten(list_transform(range({low}, greatest({low}, least({high}, length(w) + 2)) + 1), "
        f"lambda n: list_transform(range(1, greatest(length(w) + 2 - n + 1, 1) + 1), lambda i: substring(' ' || w || ' ', i, n))))))"
    )
