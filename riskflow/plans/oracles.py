"""The registered queries as DuckDB SQL over the same tables."""

from __future__ import annotations

from riskflow.plans.inputs import (
    BY_EVENT,
    BY_USER,
    BY_USER_TYPE,
    EVALUATED,
    LOGIT_BIAS,
    LOGIT_WEIGHTS,
    TARGET,
    exam_columns,
)

EXAM_COLUMNS = ", ".join(exam_columns())
EVALUATED_COLUMNS = ", ".join(f"{sql} AS {name}" for name, sql in EVALUATED.items())


def exams(key: str, *extra: str) -> str:
    more = "".join(f", {e}" for e in extra)
    return f"SELECT {key} AS \"pacienteId\", {EXAM_COLUMNS}{more} FROM events"


RAW = """age, sex, chest_pain_type, resting_blood_pressure, cholesterol, fasting_blood_sugar, rest_ecg,
    max_heart_rate_achieved, exercise_induced_angina, st_depression, st_slope, num_major_vessels, thalassemia"""

LABELS = """
    CASE sex WHEN 0 THEN 'female' ELSE 'male' END AS sex,
    CASE chest_pain_type WHEN 1 THEN 'typical angina' WHEN 2 THEN 'atypical angina'
        WHEN 3 THEN 'non-anginal pain' ELSE 'asymptomatic' END AS chest_pain_type,
    CASE fasting_blood_sugar WHEN 0 THEN 'lower than 120mg/ml' ELSE 'greater than 120mg/ml' END AS fasting_blood_sugar,
    CASE rest_ecg WHEN 0 THEN 'normal' WHEN 1 THEN 'ST-T wave abnormality'
        ELSE 'left ventricular hypertrophy' END AS rest_ecg,
    CASE exercise_induced_angina WHEN 0 THEN 'no' ELSE 'yes' END AS exercise_induced_angina,
    CASE st_slope WHEN 1 THEN 'upsloping' WHEN 2 THEN 'flat' ELSE 'downsloping' END AS st_slope,
    CASE thalassemia WHEN 0 THEN 'fix' WHEN 1 THEN 'normal' WHEN 2 THEN 'fixed defect'
        ELSE 'reversable defect' END AS thalassemia"""

INPUTS = """
    age, resting_blood_pressure, cholesterol, max_heart_rate_achieved, st_depression, num_major_vessels,
    CASE WHEN sex = 0 THEN 0 ELSE 1 END AS sex_male,
    CASE WHEN chest_pain_type = 2 THEN 1 ELSE 0 END AS "chest_pain_type_atypical angina",
    CASE WHEN chest_pain_type = 3 THEN 1 ELSE 0 END AS "chest_pain_type_non-anginal pain",
    CASE WHEN chest_pain_type = 1 THEN 1 ELSE 0 END AS "chest_pain_type_typical angina",
    CASE WHEN fasting_blood_sugar = 0 THEN 1 ELSE 0 END AS "fasting_blood_sugar_lower than 120mg/ml",
    CASE WHEN rest_ecg IN (0, 1) THEN 0 ELSE 1 END AS "rest_ecg_left ventricular hypertrophy",
    CASE WHEN rest_ecg = 0 THEN 1 ELSE 0 END AS rest_ecg_normal,
    CASE WHEN exercise_induced_angina = 0 THEN 0 ELSE 1 END AS exercise_induced_angina_yes,
    CASE WHEN st_slope = 2 THEN 1 ELSE 0 END AS st_slope_flat,
    CASE WHEN st_slope = 1 THEN 1 ELSE 0 END AS st_slope_upsloping,
    CASE WHEN thalassemia = 2 THEN 1 ELSE 0 END AS "thalassemia_fixed defect",
    CASE WHEN thalassemia = 1 THEN 1 ELSE 0 END AS thalassemia_normal,
    CASE WHEN thalassemia IN (0, 1, 2) THEN 0 ELSE 1 END AS "thalassemia_reversable defect\""""

INPUT_NAMES = (
    "age",
    "resting_blood_pressure",
    "cholesterol",
    "max_heart_rate_achieved",
    "st_depression",
    "num_major_vessels",
    "sex_male",
    '"chest_pain_type_atypical angina"',
    '"chest_pain_type_non-anginal pain"',
    '"chest_pain_type_typical angina"',
    '"fasting_blood_sugar_lower than 120mg/ml"',
    '"rest_ecg_left ventricular hypertrophy"',
    "rest_ecg_normal",
    "exercise_induced_angina_yes",
    "st_slope_flat",
    "st_slope_upsloping",
    '"thalassemia_fixed defect"',
    "thalassemia_normal",
    '"thalassemia_reversable defect"',
)
LOGIT = " + ".join([str(LOGIT_BIAS), *[f"{w} * {c}" for w, c in zip(LOGIT_WEIGHTS, INPUT_NAMES)]])


def scored(key: str) -> str:
    """CTEs ending in `scored`: raw record, event_id, value and p1 for positive ages."""
    return f"""
    raw AS ({exams(key, "event_id", "value")}),
    inputs AS (SELECT "pacienteId", event_id, {INPUTS} FROM raw WHERE age > 0),
    points AS (SELECT event_id, 1 / (1 + exp(-({LOGIT}))) AS p1 FROM inputs),
    scored AS (SELECT raw.*, p1 FROM raw JOIN points USING (event_id))"""


def merged(key: str, first: str, second: str, first_date: str, second_date: str) -> str:
    """Two batches, one after the other: features of the first, scores of the last."""
    return f"""WITH {scored(key)},
    a AS (SELECT * FROM scored WHERE {first}
        QUALIFY row_number() OVER (PARTITION BY "pacienteId" ORDER BY event_id DESC) = 1),
    b AS (SELECT * FROM scored WHERE {second}
        QUALIFY row_number() OVER (PARTITION BY "pacienteId" ORDER BY event_id DESC) = 1)
    SELECT coalesce(a."pacienteId", b."pacienteId") AS "pacienteId",
        {", ".join(f'CASE WHEN a."pacienteId" IS NOT NULL THEN a.{c.strip()} ELSE b.{c.strip()} END AS {c.strip()}'
                   for c in RAW.split(","))},
        CAST(CASE WHEN coalesce(b.p1, a.p1) >= 0.5 THEN 1 ELSE 0 END AS INT) AS resultado,
        round(1 - coalesce(b.p1, a.p1), 6) AS "probabilidade_Nao",
        round(coalesce(b.p1, a.p1), 6) AS "probabilidade_Sim",
        CASE WHEN b."pacienteId" IS NULL THEN '{first_date}' ELSE '{second_date}' END AS data
    FROM a FULL OUTER JOIN b ON a."pacienteId" = b."pacienteId\""""


def hashed(key: str) -> str:
    return f"('0x' || substr(md5(CAST({key} AS VARCHAR) || ':10'), 1, 8))::BIGINT"


RATES = """
    round(CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp)::DOUBLE END, 6)::DOUBLE AS precision,
    round(CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn)::DOUBLE END, 6)::DOUBLE AS recall,
    round(CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn)::DOUBLE END, 6)::DOUBLE AS f1,
    round((CASE WHEN tp + fn = 0 THEN tn / (tn + fp)::DOUBLE WHEN tn + fp = 0 THEN tp / (tp + fn)::DOUBLE
        ELSE (tp / (tp + fn)::DOUBLE + tn / (tn + fp)::DOUBLE) / 2 END), 6)::DOUBLE AS balanced_accuracy,
    round((tp + tn) / (tp + fp + fn + tn)::DOUBLE, 6)::DOUBLE AS accuracy"""


def counts(label: str, prediction: str) -> str:
    return f"""count(*) FILTER ({label} = 1 AND {prediction} = 1) AS tp,
        count(*) FILTER ({label} = 0 AND {prediction} = 1) AS fp,
        count(*) FILTER ({label} = 1 AND {prediction} = 0) AS fn,
        count(*) FILTER ({label} = 0 AND {prediction} = 0) AS tn"""


LOSSES = """
    -avg(CASE WHEN label = 1 THEN ln(greatest(least(p1, 1 - 1e-15), 1e-15))
        ELSE ln(1 - greatest(least(p1, 1 - 1e-15), 1e-15)) END) AS log_loss,
    avg((p1 - label) * (p1 - label)) AS brier_score"""


def curves(by: str = "") -> str:
    """CTEs ending in `curves`: group, roc_auc and average_precision, by pairs and thresholds."""
    group, part = (f"{by}, ", f"PARTITION BY {by}") if by else ("", "")
    tail = f"GROUP BY {by}" if by else ""
    extra = f", event_id % 10 AS {by}" if by else ""
    return f"""
    rows AS (SELECT {EVALUATED_COLUMNS}{extra} FROM events),
    by_score AS (SELECT {group}p1, sum(label) AS pos, sum(1 - label) AS neg FROM rows GROUP BY {group}p1),
    steps AS (SELECT *,
        sum(neg) OVER ({part} ORDER BY p1) - neg AS below,
        sum(pos) OVER ({part} ORDER BY p1 DESC) AS tp,
        sum(neg) OVER ({part} ORDER BY p1 DESC) AS fp FROM by_score),
    curves AS (SELECT {group}
        sum(pos * (below + neg / 2.0))::DOUBLE / nullif(sum(pos) * sum(neg), 0) AS roc_auc,
        sum(pos * (tp / (tp + fp)::DOUBLE)) / sum(pos) AS average_precision FROM steps {tail})"""




def whole_mean(digits: int) -> str:
    """The mean of events in units of 10^-digits, half up, from sums of whole cents."""
    total, rows = "sum(round(value * 100)::BIGINT)", "count(value)"
    return f"((2 * {10**digits} * {total} + 100 * {rows}) // nullif(200 * {rows}, 0))::DOUBLE"


RUN_SCORES = f"""SELECT user_id % 20 AS candidate, event_type AS metric, event_id % 10 AS fold, {whole_mean(2)} AS value
    FROM events GROUP BY ALL"""
SUMMARY = f"""SELECT candidate, metric, round(avg(value), 0) AS mean, stddev_pop(value) AS std
    FROM ({RUN_SCORES}) GROUP BY ALL"""
RANKED = f"""SELECT *, CAST(rank() OVER (PARTITION BY metric ORDER BY mean DESC) AS INT) AS rank FROM ({SUMMARY})"""
REGISTRY = """SELECT event_type AS name, CAST(user_id % 50 AS INT) AS version,
    ['None', 'Staging', 'Production', 'Archived'][event_id % 4 + 1] AS stage,
    'models/' || event_type || '/' || CAST(user_id % 50 AS VARCHAR) AS path, ts FROM events"""
STAGES = f"""SELECT name, version, arg_max(stage, ts) AS stage, arg_max(path, ts) AS path
    FROM ({REGISTRY}) GROUP BY name, version"""

MATRIX = """WITH guessed AS (SELECT event_type AS label,
        ['view', 'click', 'error', 'signup', 'purchase'][json_extract(props, '$.k')::INT % 5 + 1] AS prediction FROM events),
    per AS (SELECT c.class, count(*) FILTER (label = c.class AND prediction = c.class) AS hits,
        count(*) FILTER (label = c.class) AS actual, count(*) FILTER (prediction = c.class) AS predicted
        FROM guessed, (SELECT DISTINCT label AS class FROM guessed) c GROUP BY c.class),
    rates AS (SELECT class,
        CASE WHEN predicted = 0 THEN 0 ELSE hits / predicted::DOUBLE END AS precision,
        CASE WHEN actual = 0 THEN 0 ELSE hits / actual::DOUBLE END AS recall,
        CASE WHEN actual + predicted = 0 THEN 0 ELSE 2 * hits / (actual + predicted)::DOUBLE END AS f1,
        actual AS support FROM per)"""

TRAINING_INDICATORS = {
    "sex_male": "sex = 1",
    "chest_pain_type_asymptomatic": "chest_pain_type = 4",
    "chest_pain_type_atypical angina": "chest_pain_type = 2",
    "chest_pain_type_non-anginal pain": "chest_pain_type = 3",
    "chest_pain_type_typical angina": "chest_pain_type = 1",
    "fasting_blood_sugar_lower than 120mg/ml": "fasting_blood_sugar = 0",
    "rest_ecg_left ventricular hypertrophy": "rest_ecg = 2",
    "rest_ecg_normal": "rest_ecg = 0",
    "exercise_induced_angina_yes": "exercise_induced_angina = 1",
    "st_slope_downsloping": "st_slope = 3",
    "st_slope_flat": "st_slope = 2",
    "st_slope_upsloping": "st_slope = 1",
    "thalassemia_fixed defect": "thalassemia = 2",
    "thalassemia_normal": "thalassemia = 1",
    "thalassemia_reversable defect": "thalassemia = 3",
}

ORACLES = {
    "json_roundtrip": f"""SELECT "pacienteId", {RAW}, CAST(NULL AS INT) AS resultado,
        CAST(NULL AS DOUBLE) AS "probabilidade_Nao", CAST(NULL AS DOUBLE) AS "probabilidade_Sim",
        CAST(NULL AS VARCHAR) AS data FROM ({exams(BY_EVENT)})""",
    "json_props": "SELECT event_id, json_extract(props, '$.k')::BIGINT AS k FROM events",
    "json_encode": """SELECT CAST(to_json({'event_id': event_id, 'user_id': user_id, 'event_type': event_type}) AS VARCHAR)
        AS body FROM events""",
    "json_publish": "SELECT c_custkey, c_nationkey, c_mktsegment FROM customer",
    "json_dirty": """SELECT event_id,
        CASE event_id % 6 WHEN 0 THEN 'p' || event_id WHEN 1 THEN CAST(event_id AS VARCHAR) END AS "pacienteId",
        CASE WHEN event_id % 6 = 0 THEN 40 END AS age,
        CASE WHEN event_id % 6 = 0 THEN CAST(3.0 AS DOUBLE) END AS st_depression,
        CAST(event_id % 6 = 0 AS INT) AS kept FROM events""",
    "json_rejects": """SELECT CASE event_id % 8 WHEN 0 THEN 'kept' WHEN 1 THEN 'not_positive' WHEN 3 THEN 'no_key'
            WHEN 4 THEN 'no_key' WHEN 5 THEN CASE WHEN floor(value) > 0 THEN 'kept' ELSE 'not_positive' END
            ELSE 'unparsable' END AS reason, count(*) AS messages, sum(event_id)::BIGINT AS event_ids
        FROM events GROUP BY reason""",
    "json_documents": """SELECT lang, count(*) AS messages,
        count(*) FILTER (CASE WHEN json_valid(text) THEN try_cast(json_extract_string(text, '$.age') AS INT) > 0 END)
        AS kept
        FROM documents GROUP BY lang""",
    "rename_select_drop": """SELECT c_custkey AS id, c_acctbal AS balance, c_nationkey AS nation,
        c_mktsegment AS segment FROM customer""",
    "placeholders": """SELECT o_orderkey, -1 AS resultado, CAST(-1.0 AS DOUBLE) AS "probabilidade_Nao",
        CAST(-1.0 AS DOUBLE) AS "probabilidade_Sim" FROM orders""",
    "load_date": "SELECT o_orderkey, '2024-01-02' AS data FROM orders",
    "positive_filter": f'SELECT "pacienteId", age FROM ({exams(BY_EVENT)}) WHERE age > 0',
    "probability_slice": """SELECT event_id, round(1 - least(value / 500.0, 1.0), 6) AS "probabilidade_Nao",
        round(least(value / 500.0, 1.0), 6) AS "probabilidade_Sim" FROM events""",
    "decode_default": """SELECT p_partkey, CASE p_size WHEN 1 THEN 'tiny' WHEN 2 THEN 'small' WHEN 3 THEN 'medium'
        ELSE 'large' END AS p_size FROM part""",
    "decode_exams": f'SELECT "pacienteId", {LABELS} FROM ({exams(BY_EVENT)})',
    "decode_keep_null": f"""SELECT "pacienteId",
        CASE WHEN sex IS NULL THEN NULL WHEN sex = 0 THEN 'female' ELSE 'male' END AS sex FROM ({exams(BY_EVENT)})""",
    "decode_strict": """SELECT p_partkey, CASE p_size WHEN 1 THEN 'tiny' WHEN 2 THEN 'small' WHEN 3 THEN 'medium'
        ELSE CAST(p_size AS VARCHAR) END AS p_size FROM part""",
    "onehot_fixed": """SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus,
        CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END AS "l_returnflag_A",
        CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END AS "l_returnflag_N",
        CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS "l_linestatus_O" FROM lineitem WHERE l_discount > 0""",
    "onehot_learned": """SELECT c_custkey,
        CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END AS "c_mktsegment_BUILDING",
        CASE WHEN c_mktsegment = 'FURNITURE' THEN 1 ELSE 0 END AS "c_mktsegment_FURNITURE",
        CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 1 ELSE 0 END AS "c_mktsegment_HOUSEHOLD",
        CASE WHEN c_mktsegment = 'MACHINERY' THEN 1 ELSE 0 END AS "c_mktsegment_MACHINERY" FROM customer""",
    "onehot_long": """SELECT p_partkey, 'p_brand' AS "column", p_brand AS level FROM part WHERE p_brand IS NOT NULL
        UNION ALL SELECT p_partkey, 'p_size', CAST(p_size AS VARCHAR) FROM part WHERE p_size IS NOT NULL""",
    "onehot_sparse": f"""WITH cells AS (
            SELECT p_partkey, unnest([1, 2, 3]) AS nth, unnest([p_name, p_brand, p_size::VARCHAR]) AS level FROM part),
        levels AS (SELECT nth, level, row_number() OVER (PARTITION BY nth ORDER BY {hashed('level')}, level) - 1 AS place
            FROM (SELECT DISTINCT nth, level FROM cells WHERE level IS NOT NULL)),
        sizes AS (SELECT c AS nth, count(level) + 1 AS size, sum(count(level) + 1) OVER (ORDER BY c) AS upto
            FROM range(1, 4) AS r(c) LEFT JOIN levels ON nth = c GROUP BY c)
        SELECT p_partkey, CAST((SELECT sum(size) FROM sizes) AS INT) AS size,
            CAST(upto - size + coalesce(place, size - 1) AS INT) AS position, CAST(1.0 AS DOUBLE) AS value
        FROM cells JOIN sizes USING (nth) LEFT JOIN levels USING (nth, level)""",
    "exam_features": f'SELECT "pacienteId", {INPUTS} FROM ({exams(BY_EVENT)}) WHERE age > 0',
    "training_features": f"""SELECT target, count(*) AS records,
        {", ".join(f'count(*) FILTER ({test}) AS "{name}"' for name, test in TRAINING_INDICATORS.items())}
        FROM ({exams(BY_EVENT, f"{TARGET} AS target")}) GROUP BY target""",
    "sentinel_union": f'SELECT "pacienteId", {RAW} FROM ({exams(BY_EVENT)}) WHERE age > 0',
    "assembled_vector": f"""WITH inputs AS (SELECT "pacienteId", {INPUTS} FROM ({exams(BY_EVENT)}) WHERE age > 0)
        {" UNION ALL ".join(
            f'SELECT "pacienteId", {i} AS position, CAST({name} AS DOUBLE) AS value FROM inputs'
            for i, name in enumerate(INPUT_NAMES))}""",
    "join_scores": """SELECT o_custkey, o_orderkey, o_totalprice, c_mktsegment
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "merge_upsert": "",
    "merge_dedup": """SELECT user_id, ts, event_id, event_type, value FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "table_upsert": "",
    "table_view": "",
    "table_ddl": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders",
    "csv_scan": f"SELECT {EXAM_COLUMNS}, {TARGET} AS target FROM events",
    "hash_split": f"SELECT event_id, CAST({hashed('event_id')} % 100 < 20 AS INT) AS is_test FROM events",
    "hash_split_frames": f"""SELECT CASE WHEN {hashed('doc_id')} % 100 < 20 THEN 'test' ELSE 'train' END AS side,
        lang, count(*) AS docs FROM documents GROUP BY ALL""",
    "class_weights": """SELECT doc_id, toxic, round(n / (k * c)::DOUBLE, 6) AS weight FROM labels
        JOIN (SELECT toxic, count(*) AS c FROM labels GROUP BY toxic) USING (toxic),
        (SELECT count(*) AS n, count(DISTINCT toxic) AS k FROM labels)""",
    "strat_folds": f"""SELECT doc_id, quality, CAST((row_number() OVER
        (PARTITION BY quality ORDER BY {hashed('doc_id')}, doc_id) - 1) % 10 AS INT) AS fold FROM labels""",
    "strat_folds_events": f"""SELECT event_id, event_type, CAST((row_number() OVER
        (PARTITION BY event_type ORDER BY {hashed('event_id')}, event_id) - 1) % 10 AS INT) AS fold FROM events""",
    "hash_split_null_keys": f"""SELECT CASE WHEN event_id % 7 <> 0 AND {hashed('event_id')} % 100 < 20 THEN 'test' ELSE 'train' END
        AS side, count(*) AS events, count(*) FILTER (event_id % 7 = 0) AS without_key FROM events GROUP BY side""",
    "strat_folds_null_keys": """SELECT event_type, CAST(fold AS INT) AS fold, n // 10 + CAST(fold < n % 10 AS INT) AS events
        FROM (SELECT event_type, count(*) AS n FROM events GROUP BY event_type), range(10) AS f(fold)
        WHERE n // 10 + CAST(fold < n % 10 AS INT) > 0""",
    "confusion_prf": f"""WITH c AS (SELECT fold, {counts("label", "prediction")}
        FROM (SELECT {EVALUATED_COLUMNS}, event_id % 10 AS fold FROM events) GROUP BY fold)
        SELECT *, {RATES} FROM c""",
    "confusion_labels": f"""WITH c AS (SELECT lang, {counts("toxic", "CAST(n_chars > 1000 AS INT)")}
        FROM labels JOIN documents USING (doc_id) GROUP BY lang) SELECT *, {RATES} FROM c""",
    "logloss_brier": f"""SELECT round(log_loss, 6) AS log_loss, round(brier_score, 6) AS brier_score
        FROM (SELECT {LOSSES} FROM (SELECT {EVALUATED_COLUMNS} FROM events))""",
    "roc_auc": f"WITH {curves()} SELECT round(roc_auc, 6) AS roc_auc FROM curves",
    "avg_precision": f"WITH {curves()} SELECT round(average_precision, 6) AS average_precision FROM curves",
    "curves_by_fold": f"""WITH {curves("fold")} SELECT fold, round(roc_auc, 6) AS roc_auc,
        round(average_precision, 6) AS average_precision FROM curves""",
    "class_report": f"""{MATRIX},
        report AS (SELECT class, precision, recall, f1, support FROM rates
        UNION ALL SELECT 'accuracy', a, a, a, n FROM (SELECT avg(CAST(label = prediction AS DOUBLE)) AS a, count(*) AS n FROM guessed)
        UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM rates
        UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support),
            sum(recall * support) / sum(support), sum(f1 * support) / sum(support), sum(support) FROM rates)
        SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
            CAST(support AS BIGINT) AS support FROM report""",
    "training_metrics": f"""WITH {curves()},
        loss AS (SELECT {LOSSES}, avg(CAST(label = prediction AS DOUBLE)) AS accuracy FROM rows),
        per AS (SELECT c.class, count(*) FILTER (label = class AND prediction = class) AS hits,
            count(*) FILTER (label = class) AS actual, count(*) FILTER (prediction = class) AS predicted
            FROM rows, (SELECT 0 AS class UNION ALL SELECT 1) c GROUP BY c.class),
        avgs AS (SELECT sum(hits / predicted::DOUBLE * actual) / sum(actual) AS precision,
            sum(hits / actual::DOUBLE * actual) / sum(actual) AS recall,
            sum(2 * hits / (actual + predicted)::DOUBLE * actual) / sum(actual) AS f1 FROM per),
        long AS (SELECT 'training_precision_score' AS metric, precision AS value FROM avgs
        UNION ALL SELECT 'training_recall_score', recall FROM avgs
        UNION ALL SELECT 'training_f1_score', f1 FROM avgs
        UNION ALL SELECT 'training_accuracy_score', accuracy FROM loss
        UNION ALL SELECT 'training_log_loss', log_loss FROM loss
        UNION ALL SELECT 'training_roc_auc_score', roc_auc FROM curves)
        SELECT metric, round(value, 6) AS value FROM long""",
    "fold_summary": f"""SELECT candidate, metric, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std
        FROM ({RUN_SCORES}) GROUP BY ALL""",
    "rank_runs": f"SELECT candidate, metric, mean, round(std, 6) AS std, rank FROM ({RANKED})",
    "rank_users": f"""SELECT *, CAST(rank() OVER (PARTITION BY metric ORDER BY mean DESC) AS INT) AS rank FROM
        (SELECT user_id AS candidate, event_type AS metric, {whole_mean(0)} AS mean FROM events GROUP BY ALL)""",
    "best_run": f"""SELECT metric, candidate, mean FROM ({RANKED})
        QUALIFY row_number() OVER (PARTITION BY metric ORDER BY rank, candidate) = 1""",
    "top5_runs": f"""SELECT candidate, metric, mean, round(std, 6) AS std, rank FROM ({RANKED})
        WHERE metric = 'purchase' ORDER BY rank, candidate LIMIT 5""",
    "grid_scores": f"""WITH grid AS (SELECT CAST(row_number() OVER (ORDER BY a, b, c, d) - 1 AS BIGINT) AS candidate,
            a AS n_estimators, b AS min_samples_split, c AS min_samples_leaf, d AS max_depth
            FROM (SELECT unnest([50, 75, 100, 125, 150, 175])::BIGINT AS a)
            CROSS JOIN (SELECT unnest([2, 4, 6, 8, 10])::BIGINT AS b)
            CROSS JOIN (SELECT unnest([1, 2, 3, 4])::BIGINT AS c)
            CROSS JOIN (SELECT unnest([5, 10, 15, 20, 25])::BIGINT AS d)),
        scores AS (SELECT event_id % 600 AS candidate, {whole_mean(6)} / 1000000 AS mean, count(*) AS events
            FROM events GROUP BY ALL)
        SELECT candidate, mean, events, n_estimators, min_samples_split, min_samples_leaf, max_depth
        FROM scores JOIN grid USING (candidate)""",
    "metric_scan": f"""SELECT 'run' || candidate AS run_id, metric, 1700000000000 AS ts,
        round(avg(value), 4) AS value, CAST(0 AS BIGINT) AS step FROM ({RUN_SCORES}) GROUP BY candidate, metric""",
    "metric_follow": f"""SELECT 'run' || candidate AS run_id, metric, 1700000000000 AS ts,
        round(avg(value), 4) AS value, CAST(0 AS BIGINT) AS step FROM ({RUN_SCORES}) GROUP BY candidate, metric""",
    "value_scan": """SELECT 'run' || user_id % 20 AS run_id, event_type AS param, CAST(count(*) AS VARCHAR) AS value
        FROM events GROUP BY ALL""",
    "run_log": f"""SELECT run_id, metric, ts, value, events FROM (SELECT 'run' || user_id AS run_id,
            event_type AS metric, min(event_id) AS ts, {whole_mean(6)} / 1000000 AS value FROM events GROUP BY ALL)
        JOIN (SELECT 'run' || user_id AS run_id, CAST(count(*) AS VARCHAR) AS events FROM events GROUP BY ALL)
        USING (run_id)""",
    "registry_stages": STAGES,
    "registry_resolve": f"""SELECT name, max(version) AS version, arg_max(path, version) AS path
        FROM ({STAGES}) WHERE stage = 'Production' GROUP BY name""",
    "udf_score": f"""WITH {scored(BY_EVENT)} SELECT "pacienteId", CAST(CASE WHEN p1 >= 0.5 THEN 1 ELSE 0 END AS INT)
        AS resultado, round(1 - p1, 6) AS "probabilidade_Nao", round(p1, 6) AS "probabilidade_Sim" FROM scored""",
    "score_messages": f"""WITH {scored(BY_EVENT)} SELECT "pacienteId", {RAW},
        CAST(CASE WHEN p1 >= 0.5 THEN 1 ELSE 0 END AS INT) AS resultado, round(1 - p1, 6) AS "probabilidade_Nao",
        round(p1, 6) AS "probabilidade_Sim", '2024-01-02' AS data FROM scored""",
    "stream_upsert": merged(BY_USER, "value < 50", "value >= 50", "2024-01-02", "2024-01-02"),
    "stream_empty_batch": merged(BY_USER, "value < 50", "value >= 50", "2024-01-02", "2024-01-02"),
    "forest_exact": f"""WITH inputs AS (SELECT "pacienteId", {INPUTS} FROM ({exams(BY_EVENT)}) WHERE age > 0)
        SELECT "pacienteId", CAST(sex_male AS INT) AS resultado, CAST(1 - sex_male AS DOUBLE) AS "probabilidade_Nao",
        CAST(sex_male AS DOUBLE) AS "probabilidade_Sim" FROM inputs""",
    "search_exact": f"""SELECT CAST(candidate AS INT) AS candidate, metric,
            CASE WHEN metric IN ('neg_log_loss', 'neg_brier_score') THEN 0.0 ELSE 1.0 END::DOUBLE AS mean,
            CAST(0.0 AS DOUBLE) AS std, CAST(1 AS INT) AS rank, CAST(0 AS INT) AS best, records
        FROM range(3) AS c(candidate), (SELECT unnest(['precision', 'recall', 'f1', 'balanced_accuracy', 'accuracy',
            'neg_log_loss', 'neg_brier_score', 'roc_auc', 'average_precision']) AS metric),
            (SELECT count(*) AS records FROM ({exams(BY_EVENT)}) WHERE age > 0)""",
    "score_upsert": merged(BY_USER_TYPE, "value < 150", "value >= 150", "2024-01-01", "2024-01-02"),
}

MERGED_ORDERS = """WITH t AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders),
    s AS (SELECT o_orderkey + 1000 AS o_orderkey, o_custkey, 'X' AS o_orderstatus, o_totalprice + 1000 AS o_totalprice
        FROM orders)
    SELECT coalesce(t.o_orderkey, s.o_orderkey) AS o_orderkey,
        CASE WHEN t.o_orderkey IS NULL THEN s.o_custkey ELSE t.o_custkey END AS o_custkey,
        CASE WHEN t.o_orderkey IS NULL THEN s.o_orderstatus ELSE t.o_orderstatus END AS o_orderstatus,
        CASE WHEN s.o_orderkey IS NULL THEN t.o_totalprice ELSE s.o_totalprice END AS o_totalprice
    FROM t FULL OUTER JOIN s ON t.o_orderkey = s.o_orderkey"""
ORACLES["merge_upsert"] = ORACLES["table_upsert"] = ORACLES["table_view"] = MERGED_ORDERS
