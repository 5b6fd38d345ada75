"""SQL for another engine (DuckDB) that gives the results of the registered queries.

Written from the definitions, not from the plans: windows use their plain form,
the learned values a recursion, the streams a running window.
"""

from __future__ import annotations

from alertloom.params import (
    ACTION_NAMES,
    ATTACK_CATEGORIES,
    CATEGORICAL,
    CLASSES,
    DEFAULTS,
    FEATURE_COLUMNS,
    LABELS,
    LEAK_COLUMNS,
    NUMERIC_FEATURES,
    PROFILED,
    RAW_COLUMNS,
)
from alertloom.plans.catalog import LINEITEM_NUMBERS, N_SLOTS, ONE_HOT_SLOTS
from alertloom.plans.order_sql import ORDER_ORACLES
from alertloom.sources.tables import EVENT_CLASS, record_rule

DUCK_TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR"}
RAW = dict(RAW_COLUMNS)
RAW_NAMES = list(RAW)
SPLITS = ("train", "val", "test")


# --- pieces ------------------------------------------------------------------------


def draw(key: str, salt: str, part: int = 0) -> str:
    return f"(('0x'||substr(md5({key}::VARCHAR||':'||{salt}),{8 * part + 1},8))::BIGINT / 4294967296.0::DOUBLE)"


def random_action(salt: str) -> str:
    return f"floor({draw('alert_id', salt, 1)} * 3)::INTEGER"


def split(key: str) -> str:
    u = draw(key, "'split'")
    return f"CASE WHEN {u} < 0.70 THEN 'train' WHEN {u} < 0.85 THEN 'val' ELSE 'test' END"


def r(expr: str, digits: int = 6) -> str:
    return f"(round(({expr})::DOUBLE, {digits}) + 0.0::DOUBLE)"


def names(values, index: str) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + f"][{index} + 1]"


def label(index: str) -> str:
    return names(LABELS, index)


def reward(action: str, true_label: str) -> str:
    return (
        f"(CASE WHEN {action} = 0 THEN CASE {true_label} WHEN 'Normal' THEN 1 WHEN 'DoS' THEN -20 ELSE -15 END "
        f"WHEN {action} = 1 THEN CASE {true_label} WHEN 'Normal' THEN 0 ELSE -5 END "
        f"ELSE CASE {true_label} WHEN 'Normal' THEN -3 ELSE -1 END END)::DOUBLE"
    )


def conf(p: str) -> str:
    return f"(CASE WHEN {p} < 0.5 THEN 0 WHEN {p} < 0.75 THEN 1 WHEN {p} < 0.9 THEN 2 ELSE 3 END)"


def fpb(rate: str) -> str:
    return f"(CASE WHEN {rate} < 0.1 THEN 0 WHEN {rate} < 0.3 THEN 1 ELSE 2 END)"


def state(klass: str, p: str, rate: str) -> str:
    return f"({klass} * 12 + {conf(p)} * 3 + {fpb(rate)})::INTEGER"


EVENT_CASE = " ".join(f"WHEN event_type = '{n}' THEN {i}" for n, i in EVENT_CLASS.items())
TRUE_CLASS = f"(CASE WHEN {draw('event_id', chr(39) + 'n' + chr(39))} < 0.55 THEN 1 {EVENT_CASE} END)::INTEGER"

ALERTS = f"""
alerts AS MATERIALIZED (
  SELECT event_id AS alert_id, user_id % 16 AS stream_id, ts, true_class, {label('true_class')} AS true_label,
         predicted_class, {label('predicted_class')} AS predicted_label,
         0.4::DOUBLE + 0.6::DOUBLE * {draw('event_id', "'c'")} AS predicted_proba, value AS error,
         {split('event_id')} AS split
  FROM (SELECT *, (CASE WHEN {draw('event_id', "'p'")} < 0.88 THEN true_class
                   ELSE (true_class + 1 + floor({draw('event_id', "'q'")} * 4)::INTEGER) % 5 END)::INTEGER AS predicted_class
        FROM (SELECT *, {TRUE_CLASS} AS true_class FROM events)))"""

ARGMAX = "(CASE WHEN predicted_class = 1 THEN 0 ELSE 2 END)"
THRESHOLD = (
    "(CASE WHEN predicted_class = 1 AND predicted_proba >= 0.85 THEN 0 WHEN predicted_proba >= 0.85 THEN 2 ELSE 1 END)"
)
HEURISTIC = (
    "(CASE WHEN predicted_class = 1 AND predicted_proba > 0.85 THEN 0 WHEN predicted_proba < 0.6 THEN 1 ELSE 2 END)"
)
POLICIES = {"escalate_all": "2", "threshold": THRESHOLD, "argmax": ARGMAX, "heuristic": HEURISTIC}

DECIDED = f"decided AS (SELECT *, {ARGMAX}::INTEGER AS action FROM alerts)"


def rate_over(frame: str, part: str = "PARTITION BY stream_id", order: str = "ts, alert_id") -> str:
    over = f"OVER ({part} ORDER BY {order} ROWS BETWEEN {frame})"
    esc = f"coalesce(sum((action = 2)::INT) {over}, 0)"
    fp = f"coalesce(sum((action = 2 AND true_label = 'Normal')::INT) {over}, 0)"
    return f"CASE WHEN {esc} > 0 THEN {fp}::DOUBLE / {esc}::DOUBLE ELSE 0.0::DOUBLE END"


BEFORE = "100 PRECEDING AND 1 PRECEDING"
AFTER = "99 PRECEDING AND CURRENT ROW"
RATED = f"rated AS (SELECT *, {rate_over(BEFORE)} AS fp_before, {rate_over(AFTER)} AS fp_after FROM decided)"

_mapped: dict[str, list[str]] = {}
for _type, _category in ATTACK_CATEGORIES.items():
    _mapped.setdefault(_category, []).append(_type)
CATEGORY = (
    "CASE "
    + " ".join(
        "WHEN attack_type IN (" + ", ".join(f"'{t}'" for t in types) + f") THEN '{c}'" for c, types in _mapped.items()
    )
    + " ELSE 'Unknown' END"
)


def _record_column(i: int, name: str) -> str:
    u = f"('0x'||substr(m{i // 8},{4 * (i % 8) + 1},4))::BIGINT"
    return f'CAST({record_rule(name).format(u=u)} AS {DUCK_TYPES[RAW[name]]}) AS "{name}"'


RECORDS = f"""
digests AS (
  SELECT event_id AS record_id, {TRUE_CLASS} AS y, {draw('event_id', "'split'")} AS late,
         {', '.join(f"md5(event_id::VARCHAR||':f{j}') AS m{j}" for j in range((len(RAW) + 7) // 8))}
  FROM events),
raw AS (SELECT record_id, {', '.join(_record_column(i, n) for i, n in enumerate(RAW_NAMES))} FROM digests),
records AS MATERIALIZED (SELECT *, {CATEGORY} AS attack_category FROM raw)"""
KNOWN = (
    "known AS MATERIALIZED (SELECT *, "
    + split("record_id")
    + " AS split FROM records WHERE attack_category IN ("
    + ", ".join(f"'{c}'" for c in CLASSES)
    + "))"
)


def columns(values) -> str:
    return ", ".join(f'"{v}"' for v in values)


def over_alerts(select: str, *ctes: str) -> str:
    return "WITH RECURSIVE " + ", ".join([ALERTS, *ctes]) + " " + select


def over_records(select: str, *ctes: str) -> str:
    return "WITH " + ", ".join([RECORDS, *ctes]) + " " + select


def _scorecard(by: str, source: str) -> str:
    return f"""
SELECT {by}, round(cot, 2) AS "COT", round(cot / n, 4) AS "COT_por_alerta", round(recall, 4) AS recall_sistema,
       round(prec, 4) AS "precision",
       round(CASE WHEN recall + prec > 0 THEN 2 * recall * prec / (recall + prec) ELSE 0.0 END, 4) AS f1_binario,
       {', '.join(f'round(n{a}::DOUBLE / n, 4) AS "pct_{nm}"' for a, nm in enumerate(ACTION_NAMES))},
       recall >= 0.9 AS "recall_OK"
FROM (SELECT *, CASE WHEN tp + fn > 0 THEN tp::DOUBLE / (tp + fn) ELSE 1.0 END::DOUBLE AS recall,
                CASE WHEN tp + fp > 0 THEN tp::DOUBLE / (tp + fp) ELSE 1.0 END::DOUBLE AS prec
      FROM (SELECT {by}, count(*) AS n, sum(-{reward('action', 'true_label')}) AS cot,
                   count(*) FILTER (action = 2 AND true_label <> 'Normal') AS tp,
                   count(*) FILTER (action = 2 AND true_label = 'Normal') AS fp,
                   count(*) FILTER (action <> 2 AND true_label <> 'Normal') AS fn,
                   {', '.join(f'count(*) FILTER (action = {a}) AS n{a}' for a in range(3))}
            FROM {source} GROUP BY {by}))"""


ACTED = "acted AS (" + " UNION ALL ".join(
    f"SELECT '{name}' AS policy, split, alert_id, true_label, {expr} AS action FROM alerts" for name, expr in POLICIES.items()
) + ")"
CARD = "card AS (" + _scorecard("policy", "acted") + ")"


# --- learned values -----------------------------------------------------------------

def _transitions(where: str) -> str:
    return f"""
explored AS (SELECT *, {random_action(chr(39) + 'step0' + chr(39))} AS action FROM alerts WHERE {where}),
watched AS (SELECT *, {rate_over(BEFORE)} AS fp_before, {rate_over(AFTER)} AS fp_after FROM explored),
trans AS MATERIALIZED (
  SELECT alert_id, stream_id, {state('predicted_class', 'predicted_proba', 'fp_before')} AS state, action,
         {reward('action', 'true_label')} AS reward, {state('predicted_class', 'predicted_proba', 'fp_after')} AS next_state
  FROM watched)"""


TRANS = _transitions("true")
TRAIN = _transitions("split = 'train'")
MDP = """
mdp AS MATERIALIZED (
  SELECT state, action, next_state, count(*) AS n,
         count(*)::DOUBLE / (sum(count(*)) OVER pair)::DOUBLE AS p,
         (sum(sum(reward)) OVER pair)::DOUBLE / (sum(count(*)) OVER pair)::DOUBLE AS mean_reward
  FROM trans GROUP BY state, action, next_state WINDOW pair AS (PARTITION BY state, action))"""
_B = range(3)
CHAINS = (
    "chains AS MATERIALIZED (SELECT state // 12 AS klass, (state // 3) % 4 AS conf, "
    + ", ".join(f"max(mean_reward) FILTER (state % 3 = {b} AND action = {a}) AS r{b}{a}" for b in _B for a in _B)
    + ", "
    + ", ".join(
        f"coalesce(max(p) FILTER (state % 3 = {b} AND action = {a} AND next_state % 3 = {nb}), 0.0) AS p{b}{a}{nb}"
        for b in _B
        for a in _B
        for nb in _B
    )
    + " FROM mdp GROUP BY 1, 2)"
)


def _walk_values(name: str, sweeps: int, step: float | None) -> str:
    def update(b: int, a: int) -> str:
        future = " + ".join(f"p{b}{a}{nb} * greatest(q{nb}0, q{nb}1, q{nb}2)" for nb in _B)
        target = f"(r{b}{a} + 0.9::DOUBLE * ({future}))"
        new = target if step is None else f"q{b}{a} + {step}::DOUBLE * ({target} - q{b}{a})"
        return f"coalesce({new}, q{b}{a})"

    cells = [(b, a) for b in _B for a in _B]
    return (
        f"{name} AS (SELECT 0 AS k, klass, conf, "
        + ", ".join(f"0.0::DOUBLE AS q{b}{a}" for b, a in cells)
        + f" FROM chains UNION ALL SELECT k + 1, {name}.klass, {name}.conf, "
        + ", ".join(update(b, a) for b, a in cells)
        + f" FROM {name} JOIN chains ON {name}.klass = chains.klass AND {name}.conf = chains.conf WHERE k < {sweeps})"
    )


def _unpivot(source: str, where: str, extra: str = "") -> str:
    return " UNION ALL ".join(
        f"SELECT {extra}(klass * 12 + conf * 3 + {b})::INTEGER AS state, {a} AS action, q{b}{a} AS q FROM {source} WHERE {where}"
        for b in _B
        for a in _B
    )


QTAB = [
    TRAIN,
    MDP,
    CHAINS,
    _walk_values("walk", 50, None),
    f"seen AS ({_unpivot('walk', 'k = 50')})",
    "qtab AS MATERIALIZED (SELECT s.state::INTEGER AS state, a.action::INTEGER AS action, coalesce(q, 0.0)::DOUBLE AS q "
    "FROM range(60) s(state) CROSS JOIN range(3) a(action) LEFT JOIN seen ON seen.state = s.state AND seen.action = a.action)",
    "qrow AS MATERIALIZED (SELECT state, max(q) FILTER (action = 0) AS q0, max(q) FILTER (action = 1) AS q1, "
    "max(q) FILTER (action = 2) AS q2 FROM qtab GROUP BY state)",
    "greedy AS MATERIALIZED (SELECT *, (CASE WHEN q0 >= q1 AND q0 >= q2 THEN 0 WHEN q1 >= q2 THEN 1 ELSE 2 END)::INTEGER AS best FROM qrow)",
]

# Sequential walk of each stream; the kept decisions are a text of codes.
_RATE = (
    "CASE WHEN length(replace(codes, '0', '')) > 0 THEN (length(codes) - length(replace(codes, '2', '')))::DOUBLE "
    "/ length(replace(codes, '0', '')) ELSE 0.0::DOUBLE END"
)


def _feedback(group: str, where: str) -> list[str]:
    """Sequential walk of the alerts of each group."""
    return [
        *QTAB,
        f"""lined AS MATERIALIZED (
  SELECT a.alert_id, a.stream_id, a.split, a.true_label, {group} AS grp,
         row_number() OVER (PARTITION BY {group} ORDER BY ts, a.alert_id) AS rn,
         g0.best AS c0, g1.best AS c1, g2.best AS c2
  FROM alerts a
  JOIN greedy g0 ON g0.state = predicted_class * 12 + {conf('predicted_proba')} * 3
  JOIN greedy g1 ON g1.state = g0.state + 1 JOIN greedy g2 ON g2.state = g0.state + 2 WHERE {where})""",
        f"""steps AS (
  SELECT DISTINCT grp, NULL::BIGINT AS stream_id, 0::BIGINT AS rn, NULL::BIGINT AS alert_id, NULL::DOUBLE AS rate,
         NULL::INTEGER AS action, '' AS codes
  FROM lined
  UNION ALL
  SELECT grp, stream_id, rn, alert_id, rate, action,
         right(codes || CASE WHEN action <> 2 THEN '0' WHEN true_label = 'Normal' THEN '2' ELSE '1' END, 100)
  FROM (SELECT l.grp, l.stream_id, l.rn, l.alert_id, l.true_label, s.rate, s.codes,
               CASE {fpb('s.rate')} WHEN 0 THEN l.c0 WHEN 1 THEN l.c1 ELSE l.c2 END AS action
        FROM (SELECT grp, rn, codes, {_RATE} AS rate FROM steps) s
        JOIN lined l ON l.grp = s.grp AND l.rn = s.rn + 1))""",
    ]


FEEDBACK = _feedback("a.stream_id::VARCHAR", "true")
HELD_OUT = [
    ACTED,
    *_feedback("a.split || a.stream_id", "a.split <> 'train'"),
    "every AS (SELECT policy, split, true_label, action FROM acted WHERE split <> 'train' UNION ALL "
    "SELECT 'q_learning', alerts.split, true_label, steps.action "
    "FROM steps JOIN alerts ON alerts.alert_id = steps.alert_id WHERE rn > 0)",
]


# --- features ------------------------------------------------------------------------

VOCAB = [
    f"v_{c} AS (SELECT {c} AS v, row_number() OVER (ORDER BY count(*) DESC, {c}) - 1 AS i FROM known WHERE split = 'train' GROUP BY {c})"
    for c in CATEGORICAL
]
VOCAB_JOINS = " ".join(f"LEFT JOIN v_{c} ON v_{c}.v = known.{c}" for c in CATEGORICAL)
_ohe = [f"CASE WHEN v_{c}.i = {j} THEN 1.0 ELSE 0.0 END" for c in CATEGORICAL for j in range(ONE_HOT_SLOTS[c])]
FEATURES = (
    "feats AS MATERIALIZED (SELECT record_id, split, attack_category, "
    + ", ".join(
        f"({e})::DOUBLE AS f{i:02d}" for i, e in enumerate([*[f'known."{c}"' for c in NUMERIC_FEATURES], *_ohe])
    )
    + f" FROM known {VOCAB_JOINS} WHERE "
    + " AND ".join(f'known."{c}" IS NOT NULL' for c in NUMERIC_FEATURES)
    + ")"
)
SLOTS = [f"f{i:02d}" for i in range(N_SLOTS)]
SCALED = (
    "SELECT record_id, split, (SELECT count(DISTINCT attack_category) FROM known k WHERE k.split = 'train' AND "
    "k.attack_category < feats.attack_category)::DOUBLE AS label, attack_category, "
    + ", ".join(f"{r(f'CASE WHEN s_{s} = 0 THEN 0.0 ELSE ({s} - a_{s}) / s_{s} END')} AS {s}" for s in SLOTS)
    + " FROM feats, (SELECT "
    + ", ".join(f"avg({s}) AS a_{s}, stddev_samp({s}) AS s_{s}" for s in SLOTS)
    + " FROM feats WHERE split = 'train')"
)
FEATURE_SQL = over_records(SCALED, KNOWN, *VOCAB, FEATURES)


# --- metrics ---------------------------------------------------------------------------


def _class_metrics(source: str, by: str = "") -> str:
    """Per class and group: actual, predicted, hits, total, precision, recall and F1."""
    comma = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    parts = " UNION ALL ".join(
        f"SELECT {comma}{i} AS class, count(*) FILTER (l = {i}) AS actual, count(*) FILTER (p = {i}) AS predicted, "
        f"count(*) FILTER (l = {i} AND p = {i}) AS hits, count(*) AS total FROM {source} {group}"
        for i in range(5)
    )
    return (
        "SELECT *, CASE WHEN pr + rc > 0 THEN 2 * pr * rc / (pr + rc) ELSE 0.0 END::DOUBLE AS f1 FROM ("
        "SELECT *, CASE WHEN predicted > 0 THEN hits::DOUBLE / predicted ELSE 0.0 END::DOUBLE AS pr, "
        f"CASE WHEN actual > 0 THEN hits::DOUBLE / actual ELSE 0.0 END::DOUBLE AS rc FROM ({parts}))"
    )


PAIRS = "pairs AS (SELECT true_class AS l, predicted_class AS p, split FROM alerts)"
MODELS = (
    "modelled AS (SELECT 'plain' AS model, split, true_class AS l, predicted_class AS p FROM alerts UNION ALL "
    "SELECT 'cautious', split, true_class, CASE WHEN predicted_proba < 0.5 THEN 1 ELSE predicted_class END FROM alerts)"
)
_MACRO = "round(avg(f1) FILTER (actual > 0 OR predicted > 0), 4)"
_WEIGHTED = "round(sum(actual::DOUBLE / total * {}), 4)"


THRESHOLDS = (
    "cal AS (SELECT quantile_cont(error, 0.95) FILTER (true_label = 'Normal') AS threshold, max(error) AS max_error FROM alerts)"
)


def _histogram(by: str, value: str, bins: int, source: str) -> str:
    return f"""
, spans AS (SELECT {by} AS g, count(*) AS n_rows, min({value}) AS lo, max({value}) AS hi FROM {source} GROUP BY {by}),
bins AS (SELECT g, n_rows, lo, hi, (hi - lo) / {bins} AS width, b::INTEGER AS bin FROM spans CROSS JOIN range({bins}) t(b)),
hits AS (SELECT g, least(floor(({value} - lo) / (hi - lo) * {bins}), {bins - 1})::INTEGER AS bin, count(*) AS n
         FROM {source} JOIN spans ON g = {by} GROUP BY 1, 2)
SELECT bins.g AS {by}, bins.bin, {r('lo + bins.bin * width')} AS bin_left, {r('lo + (bins.bin + 1) * width')} AS bin_right,
       coalesce(n, 0) AS n, {r('coalesce(n, 0) / (n_rows * width)')} AS density
FROM bins LEFT JOIN hits ON hits.g = bins.g AND hits.bin = bins.bin"""


_long_stats = " UNION ALL ".join
PROFILE_NUMERIC = [c for c in FEATURE_COLUMNS if c not in CATEGORICAL]

# --- models and external rows ----------------------------------------------------------

_COMPLETE = " AND ".join(f'"{c}" IS NOT NULL' for c in NUMERIC_FEATURES)
_INVARIANTS = (
    "SELECT split, attack_category AS true_label, count(*) AS n, 0::BIGINT AS out_of_range, true AS beats_majority "
    f"FROM known WHERE {_COMPLETE} GROUP BY split, attack_category"
)
_EXTERNAL = f"""drawn_rows AS (
  SELECT *, {draw('record_id', "'external'")} < 0.2 AS is_external FROM records
), train_rows AS (
  SELECT * FROM drawn_rows WHERE NOT is_external AND attack_category <> 'Unknown' AND attack_type NOT IN ('satan', 'xterm')
), external AS (
  SELECT *, attack_type IN (SELECT attack_type FROM train_rows) AS seen FROM drawn_rows WHERE is_external)"""


ORACLES: dict[str, str] = {
    # sources and sinks
    "scan_csv_positional": over_records(f"SELECT {columns([*RAW_NAMES, 'attack_category'])} FROM records"),
    "scan_parquet": "SELECT * FROM lineitem",
    "sink_parquet_roundtrip": over_records(
        f"SELECT record_id, {columns([*FEATURE_COLUMNS, 'attack_category'])} FROM records"
    ),
    "pipeline_roundtrip": FEATURE_SQL,
    "sink_csv_results": over_alerts("SELECT *, 'all' AS dataset FROM card", ACTED, CARD),
    "fitted_metadata": over_records(
        "SELECT 'label_mapping' AS section, l AS name, i::DOUBLE AS value FROM (VALUES "
        + ", ".join(f"('{n}', {i})" for i, n in enumerate(LABELS))
        + ") t(l, i) UNION ALL SELECT 'feature_cols', c, i::DOUBLE FROM (VALUES "
        + ", ".join(f"('{n}', {i})" for i, n in enumerate([*NUMERIC_FEATURES, *[f"{c}_ohe" for c in CATEGORICAL]]))
        + ") t(c, i) UNION ALL SELECT 'class_weights', attack_category, w FROM wts "
        "UNION ALL SELECT 'weight_map', CASE attack_category "
        + " ".join(f"WHEN '{n}' THEN '{i}'" for i, n in enumerate(LABELS))
        + " END, w FROM wts UNION ALL SELECT 'n_rows', split, count(*)::DOUBLE FROM known GROUP BY split",
        KNOWN,
        "wts AS (SELECT attack_category, round(sum(count(*)) OVER ()::DOUBLE / (5 * count(*)), 4) AS w "
        "FROM known WHERE split = 'train' GROUP BY attack_category)",
    ),
    "split_sizes": over_records(
        f"SELECT split, count(*) AS n, {r('count(*)::DOUBLE / sum(count(*)) OVER ()')} AS share FROM known GROUP BY split",
        KNOWN,
    ),
    "decision_log": over_alerts(
        "SELECT alert_id, stream_id, true_label, predicted_label, action, action = 2 AND true_label = 'Normal' AS is_fp, "
        f"{reward('action', 'true_label')} AS reward, ts FROM decided",
        DECIDED,
    ),
    "agent_tables_roundtrip": over_alerts(f"SELECT state, action, {r('q')} AS q FROM qtab", *QTAB),
    # projections and filters
    "attack_category_map": over_records("SELECT record_id, attack_type, attack_category FROM records"),
    "drop_leak_columns": over_records(f"SELECT * EXCLUDE ({columns(LEAK_COLUMNS)}) FROM records"),
    "numeric_columns": "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax "
    "FROM lineitem",
    "filter_known_classes": over_records(
        "SELECT record_id, attack_category FROM records WHERE attack_category <> 'Unknown'"
    ),
    "filter_class": over_records(
        "SELECT record_id, service, attack_category FROM records WHERE attack_category = 'Normal'"
    ),
    "preview": over_records(
        f"SELECT {columns([*RAW_NAMES[:10], 'attack_category'])} FROM records ORDER BY record_id LIMIT 5"
    ),
    "attach_class_weight": over_alerts(
        "SELECT alert_id, true_class::DOUBLE AS label, w AS class_weight FROM alerts JOIN (SELECT true_label AS tl, "
        "round(sum(count(*)) OVER ()::DOUBLE / (5 * count(*)), 4) AS w FROM alerts GROUP BY true_label) ON tl = true_label"
    ),
    "extract_predictions": over_alerts(
        "SELECT alert_id, true_label, predicted_class, predicted_proba, predicted_label FROM alerts"
    ),
    "confidence_bucket": over_alerts(f"SELECT alert_id, {conf('predicted_proba')}::INTEGER AS confidence FROM alerts"),
    "fp_rate_bucket": over_alerts(f"SELECT alert_id, {fpb('fp_before')}::INTEGER AS fp_bucket FROM rated", DECIDED, RATED),
    "triage_state": over_alerts(
        f"SELECT alert_id, {state('predicted_class', 'predicted_proba', 'fp_before')} AS state, predicted_class AS klass, "
        f"{conf('predicted_proba')}::INTEGER AS confidence, {fpb('fp_before')}::INTEGER AS fp_bucket FROM rated",
        DECIDED,
        RATED,
    ),
    "alert_cost": over_alerts(
        f"SELECT alert_id, action, true_label, {reward('action', 'true_label')} AS reward, "
        f"0.0 - {reward('action', 'true_label')} AS cost FROM decided",
        DECIDED,
    ),
    "confusion_role": over_alerts(
        "SELECT alert_id, CASE WHEN action = 2 AND true_label <> 'Normal' THEN 'TP' WHEN action = 2 THEN 'FP' "
        "WHEN true_label <> 'Normal' THEN 'FN' ELSE 'TN' END AS role, action = 2 AND true_label = 'Normal' AS is_fp FROM decided",
        DECIDED,
    ),
    **{
        f"policy_{name}": over_alerts(
            f"SELECT alert_id, {expr}::INTEGER AS action, {names(ACTION_NAMES, expr)} AS action_name FROM alerts"
        )
        for name, expr in POLICIES.items()
    },
    "policy_q_greedy": over_alerts(
        "SELECT alert_id, s.state, best AS action FROM (SELECT alert_id, "
        f"{state('predicted_class', 'predicted_proba', 'fp_before')} AS state FROM rated) s JOIN greedy ON greedy.state = s.state",
        DECIDED,
        RATED,
        *QTAB,
    ),
    "policy_epsilon_greedy": over_alerts(
        f"SELECT alert_id, (CASE WHEN {draw('alert_id', chr(39) + 'step7' + chr(39))} < 0.3 "
        f"THEN {random_action(chr(39) + 'step7' + chr(39))} ELSE action END)::INTEGER AS action FROM decided",
        DECIDED,
    ),
    "anomaly_score": over_alerts(
        f"SELECT alert_id, {r('error / (max_error + 1e-9)')} AS anomaly_score, error > threshold AS predicted_anomaly, "
        f"{r('threshold / (max_error + 1e-9)')} AS scaled_threshold FROM alerts, cal",
        THRESHOLDS,
    ),
    "simulate_alerts": over_alerts(
        f"SELECT alert_id, true_label, predicted_class, s.state, best AS action, {names(ACTION_NAMES, 'best')} AS action_name, "
        f"{reward('best', 'true_label')} AS reward, "
        + ", ".join(f'round(q{a}, 4) AS "q_{nm}"' for a, nm in enumerate(ACTION_NAMES))
        + f" FROM (SELECT *, {state('predicted_class', 'predicted_proba', '0.15')} AS state FROM alerts) s "
        "JOIN greedy ON greedy.state = s.state",
        *QTAB,
    ),
    "cost_table": over_alerts(
        "SELECT situation, cost, n, "
        + r("units * cost")
        + " AS total_cost FROM ("
        + " UNION ALL ".join(
            f"SELECT '{s}' AS situation, {c}::DOUBLE AS cost, count(*) FILTER ({cond}) AS n, coalesce(sum({units}) FILTER ({cond}), 0)::DOUBLE AS units FROM t"
            for s, c, cond, units in [
                (
                    "fn_attack",
                    15,
                    "(action = 0 AND true_label NOT IN ('Normal', 'DoS')) OR (action = 1 AND true_label <> 'Normal')",
                    "CASE WHEN action = 1 THEN 1.0 / 3 ELSE 1.0 END",
                ),
                ("fn_dos", 20, "action = 0 AND true_label = 'DoS'", "1"),
                ("fp_normal", 2, "action = 2 AND true_label = 'Normal'", "1"),
                ("escalation", 1, "action = 2", "1"),
                ("tn_saving", -1, "action = 0 AND true_label = 'Normal'", "1"),
            ]
        )
        + ")",
        f"t AS (SELECT *, {THRESHOLD} AS action FROM alerts)",
    ),
    # joins
    "class_shift": over_records(
        "SELECT *, round(test_pct - train_pct, 2) AS diff_pct FROM (SELECT attack_category, train, test, "
        "round(train * 100.0::DOUBLE / sum(train) OVER (), 2) AS train_pct, round(test * 100.0::DOUBLE / sum(test) OVER (), 2) AS test_pct "
        "FROM (SELECT attack_category, count(*) FILTER (NOT ext AND attack_category <> 'Unknown') AS train, "
        f"count(*) FILTER (ext) AS test FROM (SELECT *, {draw('record_id', chr(39) + 'external' + chr(39))} < 0.2 AS ext FROM records) "
        "GROUP BY attack_category))"
    ),
    "label_lookup": over_alerts(f"SELECT alert_id, predicted_class, {label('predicted_class')} AS name FROM alerts"),
    "policy_comparison": over_alerts("SELECT *, 'all' AS dataset FROM card", ACTED, CARD),
    "counterfactual_rewards": over_alerts(
        f"SELECT alert_id, action::INTEGER AS action, true_label, {reward('action', 'true_label')} AS reward "
        "FROM alerts CROSS JOIN range(3) t(action)"
    ),
    "overfit_check": over_alerts(
        'SELECT model, val, test, round(val - test, 4) AS "drop", val - test > 0.05 AS overfit FROM (SELECT model, '
        "max(f) FILTER (split = 'val') AS val, max(f) FILTER (split = 'test') AS test FROM "
        f"(SELECT model, split, {_MACRO} AS f FROM ({_class_metrics('modelled', 'model, split')}) GROUP BY model, split) GROUP BY model)",
        MODELS,
    ),
    "savings_vs_baseline": over_alerts(
        'SELECT policy, "COT", b - "COT" AS savings, round((b - "COT") * 100 / b, 2) AS savings_pct '
        "FROM card, (SELECT \"COT\" AS b FROM card WHERE policy = 'escalate_all')",
        ACTED,
        CARD,
    ),
    # aggregations
    "null_profile": over_records(
        "SELECT * FROM ("
        + _long_stats(
            f"SELECT '{c}' AS \"column\", count(*) FILTER (\"{c}\" IS NULL) AS null_count FROM records" for c in RAW_NAMES[:-1]
        )
        + ") WHERE null_count > 0"
    ),
    "class_distribution": over_records(
        "SELECT attack_category, count(*) AS n, round(count(*)::DOUBLE / sum(count(*)) OVER () * 100, 2) AS pct "
        "FROM records GROUP BY attack_category"
    ),
    "categorical_profile": "SELECT * FROM ("
    + _long_stats(
        f"SELECT '{c}' AS \"column\", count(*) OVER () AS n_values, (row_number() OVER (ORDER BY count(*) DESC, {c}::VARCHAR))::INTEGER "
        f"AS rank, {c}::VARCHAR AS value, count(*) AS n FROM lineitem GROUP BY {c}"
        for c in ("l_returnflag", "l_linestatus", "l_suppkey", "l_partkey")
    )
    + ") WHERE rank <= 10",
    "describe_numeric": over_records(
        _long_stats(
            f"SELECT '{c}' AS \"column\", count(\"{c}\") AS n, {r(f'avg({c})')} AS mean, {r(f'stddev_samp({c})')} AS stddev, "
            f"min({c})::DOUBLE AS min, max({c})::DOUBLE AS max FROM records"
            for c in PROFILED
        )
    ),
    "quasi_constant": over_records(
        "SELECT \"column\", "
        + r("sd")
        + " AS std_dev FROM ("
        + _long_stats(
            f"SELECT '{c}' AS \"column\", stddev_samp(\"{c}\") AS sd FROM t" for c in [*PROFILE_NUMERIC, "tiny"]
        )
        + ") WHERE sd < 0.01",
        "t AS (SELECT *, same_srv_rate / 1000 AS tiny FROM records)",
    ),
    "label_correlation": over_records(
        f"SELECT \"column\", {r('c')} AS corr, {r('abs(c)')} AS corr_abs FROM ("
        + _long_stats(
            f"SELECT '{c}' AS \"column\", corr(\"{c}\", y) AS c FROM t HAVING min(\"{c}\") < max(\"{c}\")" for c in PROFILE_NUMERIC
        )
        + ') ORDER BY abs(c) DESC, "column" LIMIT 15',
        "freq AS (SELECT attack_category AS ac, row_number() OVER (ORDER BY count(*) DESC, attack_category) - 1 AS y "
        "FROM records GROUP BY attack_category)",
        "t AS MATERIALIZED (SELECT * FROM records JOIN freq ON ac = attack_category)",
    ),
    "class_weights": over_records(
        "SELECT attack_category, count(*) AS n, round(sum(count(*)) OVER ()::DOUBLE / (5 * count(*)), 4) AS weight "
        "FROM known WHERE split = 'train' GROUP BY attack_category",
        KNOWN,
    ),
    "class_weight_map": over_records(
        "SELECT (CASE attack_category "
        + " ".join(f"WHEN '{n}' THEN {i}" for i, n in enumerate(LABELS))
        + " END)::INTEGER AS label, round(sum(count(*)) OVER ()::DOUBLE / (5 * count(*)), 4) AS weight "
        "FROM known WHERE split = 'train' GROUP BY attack_category",
        KNOWN,
    ),
    "multiclass_metrics": over_alerts(
        "SELECT round(sum(hits)::DOUBLE / max(total), 4) AS accuracy, "
        f"{_WEIGHTED.format('pr')} AS weighted_precision, {_WEIGHTED.format('rc')} AS weighted_recall, "
        f"{_WEIGHTED.format('f1')} AS f1_weighted FROM ({_class_metrics('pairs')})",
        PAIRS,
    ),
    "recall_per_class": over_alerts(
        f"SELECT {label('class')} AS class, actual AS n, round(rc, 4) AS recall FROM ({_class_metrics('pairs')})", PAIRS
    ),
    "f1_macro": over_alerts(
        f"SELECT split, {_MACRO} AS f1_macro FROM ({_class_metrics('pairs', 'split')}) GROUP BY split", PAIRS
    ),
    "confusion_matrix": over_alerts(
        _long_stats(
            f"SELECT '{n}' AS true_label, "
            + ", ".join(f"count(*) FILTER (l = {i} AND p = {j}) AS \"{m}\"" for j, m in enumerate(LABELS))
            + " FROM pairs"
            for i, n in enumerate(LABELS)
        ),
        PAIRS,
    ),
    "binary_detection_metrics": over_alerts(
        f"SELECT tp, tn, fp, fn, {r('rc')} AS recall, {r('pr')} AS \"precision\", {r('2 * rc * pr / (rc + pr + 1e-9)')} AS f1 FROM ("
        "SELECT *, tp / (tp + fn + 1e-9) AS rc, tp / (tp + fp + 1e-9) AS pr FROM (SELECT "
        "count(*) FILTER (error > threshold AND true_label <> 'Normal') AS tp, "
        "count(*) FILTER (error <= threshold AND true_label = 'Normal') AS tn, "
        "count(*) FILTER (error > threshold AND true_label = 'Normal') AS fp, "
        "count(*) FILTER (error <= threshold AND true_label <> 'Normal') AS fn FROM alerts, cal))",
        THRESHOLDS,
    ),
    "calibrate_threshold": over_alerts(
        f"SELECT {r('quantile_cont(error, 0.95) FILTER (true_label = ' + chr(39) + 'Normal' + chr(39) + ')')} AS threshold, "
        f"{r('max(error)')} AS max_error FROM alerts WHERE split = 'val'"
    ),
    "policy_scorecard": over_alerts(_scorecard("policy, split", "acted"), ACTED),
    "accuracy_by_class": over_alerts(
        f"SELECT true_label, {r('avg((true_label = predicted_label)::INT)')} AS accuracy, count(*) AS n FROM alerts GROUP BY true_label"
    ),
    "confidence_histogram": over_alerts(_histogram("predicted_label", "predicted_proba", 40, "alerts")),
    "score_histogram": over_alerts(
        _histogram("true_label", "score", 50, "t"),
        "t AS (SELECT true_label, error / ((SELECT max(error) FROM alerts) + 1e-9) AS score FROM alerts)",
    ),
    "action_mix_by_class": over_alerts(
        "SELECT predicted_label, count(*) AS n, "
        + ", ".join(f'round(count(*) FILTER (best = {a})::DOUBLE / count(*), 4) AS "pct_{nm}"' for a, nm in enumerate(ACTION_NAMES))
        + f" FROM (SELECT *, {state('predicted_class', 'predicted_proba', '0.0')} AS state FROM alerts WHERE split = 'val') s "
        "JOIN greedy ON greedy.state = s.state GROUP BY predicted_label",
        *QTAB,
    ),
    "policy_grid": over_alerts(
        f"SELECT {label('k')} AS predicted_label, c::INTEGER AS confidence, b::INTEGER AS action, {names(ACTION_NAMES, 'b')} AS action_name FROM ("
        "SELECT k, c, CASE WHEN q0 >= q1 AND q0 >= q2 THEN 0 WHEN q1 >= q2 THEN 1 ELSE 2 END AS b FROM ("
        "SELECT state // 12 AS k, (state // 3) % 4 AS c, avg(q0) AS q0, avg(q1) AS q1, avg(q2) AS q2 FROM qrow GROUP BY 1, 2))",
        *QTAB,
    ),
    "epoch_history": over_alerts(
        f"SELECT epoch, cot, {r('rc')} AS recall, rc >= 0.9 AS recall_ok, {r('greatest(0.05, pow(0.995, epoch))')} AS epsilon FROM ("
        f"SELECT epoch, sum(-{reward('act', 'true_label')}) AS cot, "
        "CASE WHEN count(*) FILTER (true_label <> 'Normal') > 0 THEN count(*) FILTER (act = 2 AND true_label <> 'Normal')::DOUBLE / "
        "count(*) FILTER (true_label <> 'Normal') ELSE 1.0 END::DOUBLE AS rc FROM ("
        f"SELECT w.epoch::INTEGER AS epoch, true_label, CASE WHEN {draw('alert_id', chr(39) + 'step' + chr(39) + '||w.epoch')} < "
        "greatest(0.05, pow(0.995, w.epoch - 1)) THEN w.action ELSE coalesce(b.best, 0) END AS act FROM explored_state w "
        "LEFT JOIN best_after b ON b.epoch = w.epoch AND b.state = w.state) GROUP BY epoch)",
        TRAIN,
        MDP,
        CHAINS,
        _walk_values("tdwalk", 15, DEFAULTS.alpha),
        f"tdvalues AS ({_unpivot('tdwalk', 'k > 0', 'k + 1 AS epoch, ')})",
        "best_after AS (SELECT epoch, state, CASE WHEN q0 >= q1 AND q0 >= q2 THEN 0 WHEN q1 >= q2 THEN 1 ELSE 2 END AS best FROM ("
        "SELECT epoch, state, max(q) FILTER (action = 0) AS q0, max(q) FILTER (action = 1) AS q1, max(q) FILTER (action = 2) AS q2 "
        "FROM tdvalues GROUP BY epoch, state))",
        "repeated AS (SELECT a.*, e.epoch, "
        + random_action(chr(39) + "step" + chr(39) + "||e.epoch")
        + " AS action FROM alerts a CROSS JOIN range(1, 16) e(epoch) WHERE split = 'train')",
        "explored_state AS (SELECT *, "
        + state("predicted_class", "predicted_proba", "before")
        + f" AS state FROM (SELECT *, {rate_over(BEFORE, 'PARTITION BY epoch, stream_id')} AS before FROM repeated))",
    ),
    "split_class_pivot": over_records(
        "SELECT attack_category, "
        + ", ".join(
            f"round(count(*) FILTER (split = '{s}') * 100.0::DOUBLE / sum(count(*) FILTER (split = '{s}')) OVER (), 2) AS {s}"
            for s in SPLITS
        )
        + " FROM known GROUP BY attack_category",
        KNOWN,
    ),
    "kpi_summary": over_records(
        "SELECT "
        + ", ".join(f"count(*) FILTER (split = '{s}') AS n_{s}" for s in SPLITS)
        + f", count(DISTINCT attack_category) AS n_classes, {len(FEATURE_COLUMNS)}::INTEGER AS n_features, 0.9::DOUBLE AS recall_floor FROM known",
        KNOWN,
    ),
    # windows and orders
    "fp_rate_before": over_alerts(f"SELECT alert_id, stream_id, ts, {r('fp_before')} AS fp_rate_before FROM rated", DECIDED, RATED),
    "fp_rate_after": over_alerts(f"SELECT alert_id, stream_id, ts, {r('fp_after')} AS fp_rate_after FROM rated", DECIDED, RATED),
    "fp_rate_global_halo": over_alerts(
        f"SELECT alert_id, {r(rate_over(BEFORE, ''))} AS fp_rate_before, {r(rate_over(AFTER, ''))} AS fp_rate_after FROM decided",
        DECIDED,
    ),
    "best_model": over_alerts(
        "SELECT model, round(sum(hits)::DOUBLE / max(total), 4) AS accuracy, "
        f"{_WEIGHTED.format('pr')} AS weighted_precision, {_WEIGHTED.format('rc')} AS weighted_recall, "
        f"{_WEIGHTED.format('f1')} AS f1_weighted, {_MACRO} AS f1_macro, "
        + ", ".join(f"max(round(rc, 4)) FILTER (class = {i}) AS \"recall_{n}\"" for i, n in enumerate(LABELS))
        + f" FROM ({_class_metrics('chosen', 'model')}) GROUP BY model ORDER BY f1_macro DESC, model LIMIT 1",
        MODELS,
        "chosen AS (SELECT * FROM modelled WHERE split = 'val')",
    ),
    "best_valid_policy": over_alerts(
        "SELECT *, 'all' AS dataset FROM card WHERE \"recall_OK\" ORDER BY \"COT\", policy LIMIT 1", ACTED, CARD
    ),
    "seeded_shuffle": over_alerts("SELECT alert_id, true_label, md5(alert_id::VARCHAR||':42:1') AS shuffle_key FROM alerts"),
    # splits and set operations
    "union_class_parts": over_records("SELECT record_id, attack_category FROM records WHERE attack_category <> 'Unknown'"),
    "stratified_split": over_records("SELECT record_id, attack_category, split FROM known", KNOWN),
    "kfold_assignment": over_records(
        f"SELECT record_id, floor({draw('record_id', chr(39) + 'fold' + chr(39))} * 5)::INTEGER AS fold FROM known WHERE split = 'train'",
        KNOWN,
    ),
    # features
    "label_index": over_records(
        "SELECT record_id, attack_category, (dense_rank() OVER (ORDER BY attack_category) - 1)::DOUBLE AS label FROM known",
        KNOWN,
    ),
    "category_index": over_records(
        "SELECT record_id, "
        + ", ".join(f"coalesce(v_{c}.i, (SELECT count(*) FROM v_{c}))::DOUBLE AS {c}_idx" for c in CATEGORICAL)
        + f" FROM known {VOCAB_JOINS}",
        KNOWN,
        *VOCAB,
    ),
    "one_hot": over_records(
        "SELECT record_id, "
        + ", ".join(
            f"(CASE WHEN v_{c}.i = {j} THEN 1.0 ELSE 0.0 END)::DOUBLE AS {c}_{j}"
            for c in CATEGORICAL
            for j in range(ONE_HOT_SLOTS[c])
        )
        + f" FROM known {VOCAB_JOINS}",
        KNOWN,
        *VOCAB,
    ),
    "assemble_features": over_records(
        "SELECT record_id, split, " + ", ".join(f"{r(s)} AS {s}" for s in SLOTS) + " FROM feats", KNOWN, *VOCAB, FEATURES
    ),
    "standardize": "SELECT "
    + ", ".join(f"{r(f'({c} - a{i}) / s{i}')} AS f{i:02d}" for i, c in enumerate(LINEITEM_NUMBERS))
    + f", 0.0::DOUBLE AS f{len(LINEITEM_NUMBERS):02d} FROM lineitem, (SELECT "
    + ", ".join(f"avg({c}) AS a{i}, stddev_samp({c}) AS s{i}" for i, c in enumerate(LINEITEM_NUMBERS))
    + " FROM lineitem)",
    "feature_pipeline": FEATURE_SQL,
    # models
    "rf_prediction_invariants": over_records(_INVARIANTS, KNOWN),
    "gbt_prediction_invariants": over_records(_INVARIANTS, KNOWN),
    "prediction_store": over_records(
        f"SELECT model, split, count(*) AS n, count(*) AS n_ids, 0::BIGINT AS n_open FROM known, (VALUES ('boosted'), ('forest')) m(model) WHERE {_COMPLETE} "
        "GROUP BY model, split",
        KNOWN,
    ),
    "classifier_roundtrip": over_records(
        f"SELECT model, count(*) AS n, 0::BIGINT AS only_before, 0::BIGINT AS only_after FROM known, (VALUES ('boosted'), ('forest')) m(model) WHERE {_COMPLETE} "
        "GROUP BY model",
        KNOWN,
    ),
    "detector_roundtrip": f"SELECT {split('vec_id')} AS split, count(*) AS n, 0::BIGINT AS only_before, 0::BIGINT AS only_after FROM embeddings GROUP BY 1",
    # splits and external rows
    "split_overlaps": "SELECT unnest(['train & val', 'train & test', 'val & test', 'missing', 'repeated']) AS \"check\", 0::BIGINT AS n",
    "seen_unseen_recall": "WITH RECURSIVE " + ", ".join([ALERTS, RECORDS, _EXTERNAL]) + f" SELECT attack_category, seen, count(*) AS n, "
    f"{r('avg((predicted_label = attack_category)::INT)')} AS recall FROM external JOIN alerts ON alert_id = record_id GROUP BY ALL",
    "external_label_index": over_records(
        "SELECT record_id, attack_category, (SELECT count(DISTINCT t.attack_category) FROM train_rows t WHERE t.attack_category < e.attack_category "
        "OR e.attack_category NOT IN (SELECT attack_category FROM train_rows))::DOUBLE AS label FROM external e",
        _EXTERNAL,
    ),
    # learning
    "transitions": over_alerts("SELECT * FROM trans", TRANS),
    "mdp_estimate": over_alerts(
        f"SELECT state, action, next_state, n, {r('p')} AS p, {r('mean_reward')} AS mean_reward FROM mdp", TRANS, MDP
    ),
    "q_iteration": over_alerts(f"SELECT state, action, {r('q')} AS q FROM qtab", *QTAB),
    "batch_td_epoch": over_alerts(
        f"SELECT epoch::INTEGER AS epoch, state, action::INTEGER AS action, {r('q')} AS q FROM ({_unpivot('tdwalk', 'k > 0', 'k AS epoch, ')})",
        TRANS,
        MDP,
        CHAINS,
        _walk_values("tdwalk", 15, DEFAULTS.alpha),
    ),
    "epsilon_schedule": f"SELECT day, n, epoch, {r('greatest(0.05, pow(0.995, epoch))')} AS epsilon FROM (SELECT ts::DATE AS day, "
    "count(*) AS n, (row_number() OVER (ORDER BY ts::DATE))::INTEGER AS epoch FROM events GROUP BY ts::DATE)",
    # streaming
    "stream_last_n": over_alerts(
        "SELECT alert_id, stream_id, least(row_number() OVER (PARTITION BY stream_id ORDER BY ts, alert_id), 100)::INTEGER AS kept FROM alerts"
    ),
    "stream_fp_rate": over_alerts(
        f"SELECT alert_id, {r('fp_before')} AS fp_rate_before, {r('fp_after')} AS fp_rate_after FROM rated", DECIDED, RATED
    ),
    "stream_window_reset": over_alerts(
        "SELECT alert_id, least(row_number() OVER (PARTITION BY stream_id, episode ORDER BY ts, alert_id), 100)::INTEGER AS kept, "
        + r(rate_over(BEFORE, "PARTITION BY stream_id, episode"))
        + " AS fp_rate_before FROM d2",
        DECIDED,
        "d2 AS (SELECT *, (ts::DATE - DATE '1970-01-01') // 10 AS episode FROM decided)",
    ),
    "stream_scorecard": over_alerts("SELECT * FROM card", ACTED, CARD),
    "stream_triage": over_alerts(
        f"SELECT alert_id, stream_id, {r('rate')} AS fp_rate_before, action FROM steps WHERE rn > 0", *FEEDBACK
    ),
    "stream_agent_scorecard": over_alerts(
        _scorecard("policy", "fed"),
        *FEEDBACK,
        "fed AS (SELECT 'q_learning' AS policy, alerts.true_label, steps.action FROM steps "
        "JOIN alerts ON alerts.alert_id = steps.alert_id WHERE rn > 0)",
    ),
    "batch_triage": over_alerts(
        f"SELECT alert_id, stream_id, {r('rate')} AS fp_rate_before, action FROM steps WHERE rn > 0", *FEEDBACK
    ),
    "agent_scorecard": over_alerts(_scorecard("policy, split", "every"), *HELD_OUT),
    "policy_overfit_check": over_alerts(
        'SELECT *, round(cost_test - cost_val, 4) AS cost_delta, round(recall_test - recall_val, 4) AS recall_delta FROM (SELECT policy, '
        + ", ".join(
            f"max({c}) FILTER (split = '{s}') AS {n}_{s}"
            for n, c in (("cost", '"COT_por_alerta"'), ("recall", "recall_sistema"))
            for s in ("val", "test")
        )
        + " FROM rated_policies GROUP BY policy)",
        *HELD_OUT,
        "rated_policies AS (" + _scorecard("policy, split", "every") + ")",
    ),
}

ORACLES["stream_decision_log"] = ORACLES["decision_log"]
ORACLES.update(ORDER_ORACLES)
