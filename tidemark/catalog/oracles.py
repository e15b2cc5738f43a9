"""The same queries as plain SQL for an independent engine."""

RAW = """
mapped AS (
  SELECT CAST(o_custkey AS DOUBLE) AS PatientId,
         l_orderkey * 10 + l_linenumber AS AppointmentID,
         CASE WHEN l_linestatus = 'F' THEN 'F' WHEN l_returnflag <> 'N' THEN 'M' END AS Gender,
         o_orderdate AS ScheduledDay,
         l_shipdate AS AppointmentDay,
         CASE WHEN l_quantity < 50 THEN CAST(l_quantity AS INTEGER) * 2 - 5 END AS Age,
         o_orderpriority AS Neighbourhood,
         CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS Scholarship,
         CASE WHEN l_discount >= 0.08 THEN 1 ELSE 0 END AS Hipertension,
         CASE WHEN l_tax >= 0.08 THEN NULL WHEN l_tax >= 0.06 THEN 1 ELSE 0 END AS Diabetes,
         CASE WHEN l_linenumber = 7 THEN 1 ELSE 0 END AS Alcoholism,
         l_linenumber % 5 AS Handcap,
         CASE WHEN l_partkey % 3 = 0 THEN 1 ELSE 0 END AS SMS_received,
         CASE WHEN o_orderstatus = 'F' THEN 'Yes' WHEN o_orderstatus = 'O' THEN 'No' END
           AS no_show_text
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
),
raw AS (
  SELECT * FROM mapped UNION ALL SELECT * FROM mapped WHERE AppointmentID % 50 = 1
)"""

RECODE = """
  SELECT PatientId, AppointmentID,
         CASE WHEN Gender = 'F' THEN 'Female' ELSE 'Male' END AS Gender,
         ScheduledDay, AppointmentDay, Age, Neighbourhood, Scholarship, Hipertension,
         Diabetes, Alcoholism, Handcap, SMS_received,
         CASE WHEN no_show_text = 'Yes' THEN 1 ELSE 0 END AS no_show"""

DERIVE = """
  SELECT PatientId, AppointmentID, Gender, Age,
         CASE WHEN Age < 18 THEN 'child' WHEN Age < 40 THEN 'young_adult'
              WHEN Age < 65 THEN 'adult' ELSE 'senior' END AS age_group,
         Neighbourhood, Scholarship, Hipertension, Diabetes, Alcoholism, Handcap,
         SMS_received AS sms_received_flag,
         CAST(date_diff('day', CAST(ScheduledDay AS DATE), CAST(AppointmentDay AS DATE))
              AS INTEGER) AS days_until_appointment,
         Hipertension + Diabetes AS chronic_disease_count,
         no_show"""

FEATURES = """Gender, Age, age_group, Scholarship, Hipertension, Diabetes, Alcoholism, Handcap,
         sms_received_flag, days_until_appointment, chronic_disease_count"""

COMPLETE = """Gender IS NOT NULL AND Age IS NOT NULL AND age_group IS NOT NULL
    AND Scholarship IS NOT NULL AND Hipertension IS NOT NULL AND Diabetes IS NOT NULL
    AND Alcoholism IS NOT NULL AND Handcap IS NOT NULL AND sms_received_flag IS NOT NULL
    AND days_until_appointment IS NOT NULL AND chronic_disease_count IS NOT NULL"""

IDENTIFIED = "PatientId IS NOT NULL AND NOT isnan(PatientId) AND AppointmentID IS NOT NULL"

SILVER = f"""{RAW},
silver AS ({RECODE} FROM (SELECT DISTINCT * FROM raw) WHERE Age >= 0)"""

GOLD = f"""{SILVER},
gold AS (SELECT * FROM ({DERIVE} FROM silver) WHERE days_until_appointment >= 0)"""

TRAINING = f"""{GOLD},
training AS (
  SELECT PatientId, AppointmentID, Neighbourhood, {FEATURES}, no_show
  FROM gold WHERE {COMPLETE} AND no_show IS NOT NULL
)"""

SCORING = f"""{GOLD},
scoring AS (
  SELECT PatientId, AppointmentID, {FEATURES} FROM gold WHERE {COMPLETE} AND {IDENTIFIED}
)"""

MIXED = "(AppointmentID * 7919 + days_until_appointment * 13)"
SCORE = f"CAST({MIXED} % 1000 AS DOUBLE) / 1000"

PREDICTED = f"""{SCORING},
scored AS (SELECT *, {SCORE} AS no_show_probability FROM scoring),
predictions AS (
  SELECT *, CASE WHEN no_show_probability >= CAST(0.3 AS DOUBLE) THEN 1 ELSE 0 END
    AS predicted_no_show
  FROM scored
)"""

STREAMED = f"""{RAW},
streamed AS (
  SELECT PatientId, AppointmentID, {FEATURES}
  FROM ({DERIVE} FROM ({RECODE} FROM raw))
  WHERE days_until_appointment >= 0 AND {COMPLETE} AND {IDENTIFIED}
)"""

LABELLED = """SELECT *, CASE WHEN predicted_no_show = 1 THEN 'Likely No-show'
  ELSE 'Likely Show' END AS prediction_label"""

RUNS_SCORED = f"""{TRAINING},
run_rows AS (
  SELECT (CAST(substr(Neighbourhood, 1, 1) AS INTEGER) - 1) * 5 + Handcap AS seq,
         concat(Neighbourhood, '/', Handcap) AS run_name, Neighbourhood AS experiment,
         no_show AS label, {SCORE} AS p
  FROM training
)"""


def _metrics(rows: str, groups: str) -> str:
    """Metrics by a plain ranking of every row; ``groups`` is a column list."""
    return f"""
ranked AS (
  SELECT {groups}, label, p,
         sum(1 - label) OVER (PARTITION BY {groups} ORDER BY p RANGE UNBOUNDED PRECEDING)
           AS upto,
         sum(1 - label) OVER (PARTITION BY {groups}, p) AS tied
  FROM {rows}
),
totals AS (
  SELECT {groups}, count(*) AS n, sum(label) AS pos, sum(1 - label) AS neg,
         sum(CASE WHEN label = 1 THEN CAST(upto - tied AS DOUBLE) + CAST(tied AS DOUBLE) / 2
             ELSE 0 END) AS pairs,
         sum(CASE WHEN p > 0.5 AND label = 1 THEN 1 ELSE 0 END) AS tp,
         sum(CASE WHEN p > 0.5 AND label = 0 THEN 1 ELSE 0 END) AS fp
  FROM ranked GROUP BY {groups}
),
runs AS (
  SELECT {groups}, n AS "rows",
         CAST(tp + neg - fp AS DOUBLE) / n AS accuracy,
         CASE WHEN pos > 0 AND neg > 0 THEN pairs / (CAST(pos AS DOUBLE) * neg) END AS roc_auc,
         CASE WHEN tp + fp = 0 THEN 0 ELSE CAST(tp AS DOUBLE) / (tp + fp) END AS "precision",
         CASE WHEN pos = 0 THEN 0 ELSE CAST(tp AS DOUBLE) / pos END AS recall,
         CASE WHEN tp + fp + pos = 0 THEN 0 ELSE CAST(2 * tp AS DOUBLE) / (tp + fp + pos) END
           AS f1_score
  FROM totals
)"""


RUNS = f"{RUNS_SCORED},{_metrics('run_rows', 'seq, run_name, experiment')}"
BOARD = f"""{RUNS},
board AS (
  SELECT *, CAST(row_number() OVER (ORDER BY roc_auc DESC NULLS LAST, run_name) AS INTEGER)
    AS "rank"
  FROM runs
)"""
METRICS = 'accuracy, roc_auc, "precision", recall, f1_score'


def _split(columns: str) -> str:
    """Split by ranking each class as a whole."""
    return f"""{TRAINING},
hashed AS (
  SELECT {columns}, md5(concat_ws(chr(31), {columns}, '42')) AS h FROM training
),
sizes AS (
  SELECT no_show, count(*) AS class_rows, sum(count(*)) OVER () AS total_rows
  FROM hashed GROUP BY no_show
),
shares AS (
  SELECT *, total_rows - CAST(ceil(CAST(0.2 AS DOUBLE) * total_rows) AS BIGINT) AS train_rows,
         CAST(class_rows AS DOUBLE) / CAST(total_rows AS DOUBLE) *
           (total_rows - CAST(ceil(CAST(0.2 AS DOUBLE) * total_rows) AS BIGINT)) AS share
  FROM sizes
),
seated AS (
  SELECT *, row_number() OVER (ORDER BY share - floor(share) DESC, no_show) AS place,
         train_rows - sum(floor(share)) OVER () AS left_over
  FROM shares
),
cuts AS (
  SELECT no_show, class_rows - floor(share) - CASE WHEN place <= left_over THEN 1 ELSE 0 END
    AS test_rows
  FROM seated
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY no_show ORDER BY h) AS n FROM hashed
),
split_rows AS (
  SELECT {columns}, CASE WHEN n <= test_rows THEN 'test' ELSE 'train' END AS split
  FROM placed JOIN cuts USING (no_show)
)"""


SPLIT_FEATURES = f"AppointmentID, {FEATURES}, no_show"
SPLIT = _split(SPLIT_FEATURES)
SPLIT_TRAINING = _split(f"PatientId, AppointmentID, {FEATURES}, no_show")
SPLIT_FEW = "Gender, age_group, Scholarship, no_show"

_CELLS = """cells AS (
  SELECT sum(CASE WHEN label = 1 AND p > 0.5 THEN 1 ELSE 0 END) AS tp,
         sum(CASE WHEN label = 0 AND p > 0.5 THEN 1 ELSE 0 END) AS fp,
         sum(CASE WHEN label = 1 AND NOT p > 0.5 THEN 1 ELSE 0 END) AS fn,
         sum(CASE WHEN label = 0 AND NOT p > 0.5 THEN 1 ELSE 0 END) AS tn
  FROM run_rows
),
by_class AS (
  SELECT 0 AS position, '0' AS "row",
         CASE WHEN tn + fn = 0 THEN 0 ELSE CAST(tn AS DOUBLE) / (tn + fn) END AS "precision",
         CASE WHEN tn + fp = 0 THEN 0 ELSE CAST(tn AS DOUBLE) / (tn + fp) END AS recall,
         CASE WHEN tn + fn + fp = 0 THEN 0 ELSE CAST(2 * tn AS DOUBLE) / (2 * tn + fn + fp) END
           AS f1_score,
         CAST(tn + fp AS BIGINT) AS support
  FROM cells
  UNION ALL
  SELECT 1, '1',
         CASE WHEN tp + fp = 0 THEN 0 ELSE CAST(tp AS DOUBLE) / (tp + fp) END,
         CASE WHEN tp + fn = 0 THEN 0 ELSE CAST(tp AS DOUBLE) / (tp + fn) END,
         CASE WHEN tp + fp + fn = 0 THEN 0 ELSE CAST(2 * tp AS DOUBLE) / (2 * tp + fp + fn) END,
         CAST(tp + fn AS BIGINT)
  FROM cells
)"""

_COUNTED = """SELECT 'bronze' AS layer, count(*) AS "rows" FROM raw
UNION ALL SELECT 'silver', count(*) FROM silver UNION ALL SELECT 'gold', count(*) FROM gold"""

DAYS_AS_TEXT = """strftime(ScheduledDay, '%Y-%m-%d %H:%M:%S') AS ScheduledDay,
  strftime(AppointmentDay, '%Y-%m-%d %H:%M:%S') AS AppointmentDay"""

RAW_AS_TEXT = f"SELECT * REPLACE ({DAYS_AS_TEXT})"
HOLDS = "1 AS is_probability, 1 AS decision_holds"
NUMERIC = [
    "Age",
    "Scholarship",
    "Hipertension",
    "Diabetes",
    "Alcoholism",
    "Handcap",
    "sms_received_flag",
    "days_until_appointment",
    "chronic_disease_count",
]


def _moments() -> str:
    """Observed weighted feature means of positive training rows."""
    values = {"rows": "1"}
    values |= {g: f"CASE WHEN Gender = '{g}' THEN 1 ELSE 0 END" for g in ("Female", "Male")}
    values |= {
        a: f"CASE WHEN age_group = '{a}' THEN 1 ELSE 0 END"
        for a in ("child", "young_adult", "adult", "senior")
    }
    values |= {c: c for c in NUMERIC}
    lines = [
        f"SELECT '{name}' AS feature, round(sum(CAST(no_show * ({value}) AS DOUBLE)) "
        f"/ (2.0 * sum(no_show)), 3) AS moment FROM train"
        for name, value in values.items()
    ]
    return " UNION ALL ".join(lines)


LEVELS = [("Gender", "Female"), ("Gender", "Male")] + [
    ("age_group", level) for level in ("adult", "child", "senior", "young_adult")
]
ENCODED = {f"{c}={v}": f"CASE WHEN {c} = '{v}' THEN 1 ELSE 0 END" for c, v in LEVELS} | {
    c: c for c in NUMERIC
}


def _stump(left: str, right: str, impurity: str, value: str, digits: int) -> str:
    """The best single split by prefix sums over every feature's values.

    A value's rows have two sums, ``left`` and ``right``; ``impurity`` and ``value`` are
    formulas of a side's sums a and b.
    """
    counted = " UNION ALL ".join(
        f"SELECT {k} AS k, '{name}' AS feature, CAST({value_of} AS DOUBLE) AS v, "
        f"sum({left}) AS a, sum({right}) AS b FROM weighted GROUP BY v"
        for k, (name, value_of) in enumerate(ENCODED.items())
    )

    def of(formula: str, a: str, b: str) -> str:
        return "(" + formula.replace("{a}", f"({a})").replace("{b}", f"({b})") + ")"

    return f"""
class_sizes AS (
  SELECT no_show, CAST(sum(count(*)) OVER () AS DOUBLE) / (2 * count(*)) AS w
  FROM split_rows WHERE split = 'train' GROUP BY no_show
),
weighted AS (
  SELECT s.*, w FROM split_rows s JOIN class_sizes USING (no_show) WHERE split = 'train'
),
counted AS ({counted}),
prefixes AS (
  SELECT k, feature, v, (v + lead(v) OVER up) / 2 AS threshold, lead(v) OVER up AS after,
         sum(a) OVER (up ROWS UNBOUNDED PRECEDING) AS la,
         sum(b) OVER (up ROWS UNBOUNDED PRECEDING) AS lb,
         sum(a) OVER (PARTITION BY k) AS ta, sum(b) OVER (PARTITION BY k) AS tb
  FROM counted WINDOW up AS (PARTITION BY k ORDER BY v)
),
gains AS (
  SELECT *, {of(impurity, "ta", "tb")}
    - (la + lb) / (ta + tb) * {of(impurity, "la", "lb")}
    - (ta + tb - la - lb) / (ta + tb) * {of(impurity, "ta - la", "tb - lb")} AS gain
  FROM prefixes WHERE after IS NOT NULL
),
best AS (SELECT * FROM gains ORDER BY round(gain, 12) DESC, k, threshold LIMIT 1)
SELECT 'both' AS side, feature, threshold, round(gain, 9) AS gain, round(ta + tb, {digits}) AS weight,
  round({of(value, "ta", "tb")}, 9) AS "value" FROM best
UNION ALL SELECT 'low', NULL, NULL, NULL, round(la + lb, {digits}), round({of(value, "la", "lb")}, 9) FROM best
UNION ALL SELECT 'high', NULL, NULL, NULL, round(ta + tb - la - lb, {digits}),
  round({of(value, "ta - la", "tb - lb")}, 9) FROM best"""


GINI = "1 - ({a} * {a} + {b} * {b}) / (({a} + {b}) * ({a} + {b}))"
# Of -1 and +1: the mean square is one.
VARIANCE = "1 - (({b} - {a}) / ({a} + {b})) * (({b} - {a}) / ({a} + {b}))"


def _records(candidates: list[tuple]) -> str:
    """Run records of (name, family, parameters)."""
    values = ", ".join(
        f"({seq}, '{name}', '{family}', '{params}')"
        for seq, (name, family, params) in enumerate(candidates)
    )
    return f"""SELECT *, 1 AS accuracy_holds, 1 AS roc_auc_holds, 1 AS precision_holds,
          1 AS recall_holds, 1 AS f1_score_holds, 1 AS listed, 1 AS best_holds
        FROM (VALUES {values}) AS grid(seq, run_name, model_type, params)"""


def _forest(trees, depth):
    return "random_forest", f"max_depth={depth};n_estimators={trees}"


def _boosted(rounds, rate):
    return "gradient_boosting", f"learning_rate={rate};max_depth=3;n_estimators={rounds}"


WHOLE_GRID = [
    ("lr_c_0_01", "logistic_regression", "C=0.01"),
    ("lr_c_0_1", "logistic_regression", "C=0.1"),
    ("lr_c_1", "logistic_regression", "C=1"),
    ("lr_c_10", "logistic_regression", "C=10"),
    ("lr_c_100", "logistic_regression", "C=100"),
    ("rf_50_depth_5", *_forest(50, 5)),
    ("rf_100_depth_8", *_forest(100, 8)),
    ("rf_200_depth_10", *_forest(200, 10)),
    ("rf_300_depth_12", *_forest(300, 12)),
    ("rf_500_depth_none", *_forest(500, 30)),
    ("gb_50_lr_0_1_depth_3", *_boosted(50, 0.1)),
    ("gb_100_lr_0_1_depth_3", *_boosted(100, 0.1)),
    ("gb_200_lr_0_1_depth_3", *_boosted(200, 0.1)),
    ("gb_100_lr_0_05_depth_3", *_boosted(100, 0.05)),
    ("gb_100_lr_0_2_depth_3", *_boosted(100, 0.2)),
]


DAMAGED = """damaged AS (
  SELECT AppointmentID, 'scored' AS outcome FROM streamed WHERE AppointmentID % 7 > 1
  UNION ALL SELECT AppointmentID, 'unreadable' FROM raw WHERE AppointmentID % 7 <= 1
)"""

GOLD_TYPES = {
    "PatientId": "double",
    "AppointmentID": "bigint",
    "Gender": "string",
    "Age": "int",
    "age_group": "string",
    "Neighbourhood": "string",
} | {c: "int" for c in [*NUMERIC[1:], "no_show"]}


def _layer_schema() -> str:
    return " UNION ALL ".join(
        f"SELECT {i} AS ordinal, '{name}' AS name, '{kind}' AS type, true AS nullable, "
        f'count(*) AS "rows", count(*) - count({name}) AS missing FROM gold'
        for i, (name, kind) in enumerate(GOLD_TYPES.items())
    )


def _widest() -> str:
    return "greatest(" + ", ".join(f"max({c}) - min({c}) + 2" for c in NUMERIC) + ")"


def _settings() -> str:
    """Settings of the whole grid: strengths by training rows, trees, rounds, rates."""
    lines = []
    for name, family, params in WHOLE_GRID:
        of = dict(p.split("=") for p in params.split(";"))
        if family == "logistic_regression":
            values = f"1.0 / ({of['C']} * n), NULL, 1000.0, NULL, NULL, NULL"
        elif family == "random_forest":
            values = f"NULL, {of['n_estimators']}.0, NULL, {of['max_depth']}.0, NULL, splits"
        else:
            values = f"NULL, NULL, {of['n_estimators']}.0, 3.0, {of['learning_rate']}, splits"
        cast = ", ".join(f"CAST({v.strip()} AS DOUBLE)" for v in values.split(","))
        lines.append(f"SELECT '{name}', {cast} FROM sized")
    return (
        "SELECT * FROM (" + " UNION ALL ".join(lines)
        + ") AS settings(run_name, reg_param, trees, rounds, depth, step, splits)"
    )


ORACLES = {
    "bronze_roundtrip": f"WITH {RAW} {RAW_AS_TEXT} FROM raw",
    "csv_scan": f"WITH {RAW} {RAW_AS_TEXT} FROM raw",
    "csv_scan_reordered": f"WITH {RAW} {RAW_AS_TEXT} FROM raw",
    "deduplicated": f"WITH {RAW} {RAW_AS_TEXT} FROM (SELECT DISTINCT * FROM raw)",
    "silver": f"WITH {SILVER} {RAW_AS_TEXT} FROM silver",
    "gold": f"WITH {GOLD} SELECT * FROM gold",
    "etl_from_csv": f"WITH {GOLD} SELECT * FROM gold",
    "gold_by_age_group": f"""WITH {GOLD} SELECT age_group, no_show, count(*) AS "rows"
        FROM gold GROUP BY age_group, no_show""",
    "etl_layer_counts": f"WITH {GOLD} {_COUNTED}",
    "training_set": f"WITH {TRAINING} SELECT {FEATURES}, no_show FROM training",
    "scoring_set": f"WITH {SCORING} SELECT * FROM scoring",
    "stratified_split": f"WITH {SPLIT} SELECT * FROM split_rows",
    "stratified_split_copies": f"WITH {_split(SPLIT_FEW)} SELECT * FROM split_rows",
    "class_weights": f"""WITH {TRAINING},
        sizes AS (SELECT no_show, count(*) AS class_rows FROM training GROUP BY no_show)
        SELECT no_show, class_rows,
          CAST(CAST(sum(class_rows) OVER () AS BIGINT) AS DOUBLE)
            / CAST(count(*) OVER () * class_rows AS DOUBLE) AS class_weight
        FROM sizes""",
    "threshold_predictions": f"""WITH {PREDICTED}
        SELECT AppointmentID, days_until_appointment, no_show_probability, predicted_no_show,
          CASE WHEN no_show_probability > 0.5 THEN 1 ELSE 0 END AS evaluation_class,
          CASE WHEN AppointmentID % 3 <> 0 THEN no_show_probability END AS score,
          CASE WHEN AppointmentID % 3 <> 0 THEN no_show_probability
               WHEN no_show_probability > 0.5 THEN 1 ELSE 0 END AS score_or_class
        FROM predictions""",
    "predictions": f"WITH {PREDICTED} SELECT * FROM predictions",
    "consolidated_predictions": f"WITH {PREDICTED} {LABELLED} FROM predictions",
    "score_response": f"""WITH {SCORING},
        rated AS (SELECT AppointmentID, CAST({MIXED} % 99991 AS DOUBLE) / 99991 AS p FROM scoring)
        SELECT AppointmentID, round(p, 4) AS no_show_probability,
          CASE WHEN p >= CAST(0.3 AS DOUBLE) THEN 1 ELSE 0 END AS predicted_no_show,
          CASE WHEN p >= CAST(0.3 AS DOUBLE) THEN 'Likely No-show' ELSE 'Likely Show' END
            AS prediction_label,
          CAST(0.3 AS DOUBLE) AS threshold
        FROM rated""",
    "prediction_counts": f"""WITH {PREDICTED} SELECT predicted_no_show, count(*) AS "count"
        FROM predictions GROUP BY predicted_no_show""",
    "prediction_percentages": f"""WITH {PREDICTED},
        counted AS (SELECT predicted_no_show, count(*) AS "count" FROM predictions
          GROUP BY predicted_no_show)
        SELECT *, round(CAST("count" AS DOUBLE) / CAST(sum("count") OVER () AS DOUBLE) * 100, 2)
          AS percentage FROM counted""",
    "label_distribution": f"""WITH {PREDICTED} SELECT prediction_label, count(*) AS "count"
        FROM ({LABELLED} FROM predictions) GROUP BY prediction_label""",
    "prediction_total": f'WITH {PREDICTED} SELECT count(*) AS "rows" FROM predictions',
    "preview": f"WITH {PREDICTED} SELECT * FROM predictions ORDER BY AppointmentID, PatientId, {FEATURES} LIMIT 20",
    "run_metrics": f"WITH {RUNS} SELECT * FROM runs",
    "overall_metrics": f"""WITH {RUNS_SCORED},
        one AS (SELECT 'all' AS run_name, label, p FROM run_rows),
        {_metrics('one', 'run_name')} SELECT * FROM runs""",
    "classification_report": f"""WITH {RUNS_SCORED}, {_CELLS}
        SELECT * FROM by_class
        UNION ALL SELECT 2, 'accuracy', NULL, NULL,
          CAST(tp + tn AS DOUBLE) / (tp + fp + fn + tn), CAST(tp + fp + fn + tn AS BIGINT)
        FROM cells
        UNION ALL SELECT 3, 'macro avg', avg("precision"), avg(recall), avg(f1_score),
          CAST(sum(support) AS BIGINT) FROM by_class
        UNION ALL SELECT 4, 'weighted avg', sum("precision" * support) / sum(support),
          sum(recall * support) / sum(support), sum(f1_score * support) / sum(support),
          CAST(sum(support) AS BIGINT) FROM by_class""",
    "leaderboard": f'WITH {BOARD} SELECT "rank", run_name, experiment, {METRICS} FROM board',
    "top15": f'WITH {BOARD} SELECT "rank", run_name, roc_auc FROM board WHERE "rank" <= 15',
    "best_run": f"""WITH {RUNS} SELECT seq, run_name, roc_auc FROM runs
        WHERE roc_auc IS NOT NULL ORDER BY roc_auc DESC, seq LIMIT 1""",
    "best_run_in_experiment": f"""WITH {BOARD} SELECT experiment, run_name, roc_auc FROM board
        WHERE experiment = '3-MEDIUM' ORDER BY "rank" LIMIT 1""",
    "latest_model": f"""WITH {RUNS}
        SELECT experiment AS name, seq % 5 + 1 AS version, concat('run-', seq) AS run_id,
          concat('models/', run_name, '/', "rows") AS uri
        FROM runs WHERE seq % 5 = 4""",
    "register_past_run": f"""WITH {BOARD},
        best AS (SELECT * FROM board WHERE experiment = '3-MEDIUM' ORDER BY "rank" LIMIT 1)
        SELECT 'past' AS name, version, concat('run-', seq) AS run_id,
          concat('models/', run_name) AS uri
        FROM best, (VALUES (1), (2)) AS v(version)""",
    "stream_features": f"WITH {STREAMED} SELECT * FROM streamed",
    "stream_consolidated": f"""WITH {STREAMED},
        scored AS (SELECT *, {SCORE} AS no_show_probability FROM streamed),
        predictions AS (SELECT *, CASE WHEN no_show_probability >= CAST(0.3 AS DOUBLE) THEN 1
          ELSE 0 END AS predicted_no_show FROM scored)
        {LABELLED} FROM predictions""",
    "training_split": f"""WITH {SPLIT_TRAINING},
        profiles AS (SELECT no_show, {FEATURES}, count(*) AS n FROM split_rows GROUP BY ALL),
        top AS (SELECT * FROM profiles ORDER BY n DESC, no_show, {FEATURES} LIMIT 1)
        SELECT no_show, split, count(*) AS "rows",
          CAST(sum(CASE WHEN (no_show, {FEATURES}) IN (SELECT (no_show, {FEATURES}) FROM top)
            THEN 1 ELSE 0 END) AS BIGINT) AS top_profile_rows
        FROM split_rows GROUP BY no_show, split""",
    "lr_moments": f"""WITH {SPLIT_TRAINING},
        train AS (SELECT * FROM split_rows WHERE split = 'train') {_moments()}""",
    "rf_scores_checked": f"""WITH {SPLIT_TRAINING}
        SELECT PatientId, AppointmentID, 'rf_20_depth_5' AS run_name, no_show AS label,
          1 AS is_probability FROM split_rows WHERE split = 'test'""",
    "gbt_scores_checked": f"""WITH {SPLIT_TRAINING}
        SELECT PatientId, AppointmentID, 'gb_10_lr_0_1_depth_3' AS run_name, no_show AS label,
          1 AS is_probability FROM split_rows WHERE split = 'test'""",
    "grid_records": _records(
        [
            ("lr_c_1", "logistic_regression", "C=1"),
            ("rf_20_depth_5", *_forest(20, 5)),
            ("gb_10_lr_0_1_depth_3", *_boosted(10, 0.1)),
        ]
    ),
    "grid_whole": _records(WHOLE_GRID),
    "rf_stump_checked": f"""WITH {SPLIT_TRAINING},
        {_stump("w * (1 - no_show)", "w * no_show", GINI, "{b} / ({a} + {b})", 3)}""",
    "gbt_stump_checked": f"""WITH {SPLIT_TRAINING},
        {_stump("CAST(1 - no_show AS DOUBLE)", "CAST(no_show AS DOUBLE)", VARIANCE, "({b} - {a}) / ({a} + {b})", 0)}""",
    "lr_gradient_checked": " UNION ALL ".join(
        f"SELECT '{name}' AS feature, CAST(0 AS DOUBLE) AS gradient, '1' AS zero_for"
        for name in [*ENCODED, "(intercept)"]
    ),
    "train_report_checked": f"""WITH {SPLIT_TRAINING},
        test AS (SELECT count(*) AS n, count(*) FILTER (no_show = 1) AS pos
          FROM split_rows WHERE split = 'test')
        SELECT position, "row", CASE "row" WHEN '0' THEN n - pos WHEN '1' THEN pos ELSE n END
          AS support, 1 AS holds
        FROM test, (VALUES (0, '0'), (1, '1'), (2, 'accuracy'), (3, 'macro avg'),
          (4, 'weighted avg')) AS lines(position, "row")""",
    "request_responses_checked": f"""WITH {SCORING}
        SELECT {FEATURES}, CAST(0.3 AS DOUBLE) AS threshold, 1 AS holds, count(*) AS requests
        FROM scoring GROUP BY ALL""",
    "stream_restarted": f"""WITH {STREAMED},
        scored AS (SELECT *, {SCORE} AS no_show_probability FROM streamed),
        predictions AS (SELECT *, CASE WHEN no_show_probability >= CAST(0.3 AS DOUBLE) THEN 1
          ELSE 0 END AS predicted_no_show FROM scored)
        {LABELLED} FROM predictions""",
    "csv_quarantine": f"""WITH {RAW}
        SELECT AppointmentID, CASE WHEN AppointmentID % 7 = 0 THEN 'quarantine' ELSE 'bronze' END
          AS place FROM raw""",
    "layer_schema": f"""WITH {GOLD} {_layer_schema()}""",
    "stream_empty_batches": f"""WITH {STREAMED},
        seen AS (SELECT AppointmentID % 4 AS batch_id, count(*) AS events FROM raw GROUP BY ALL),
        kept AS (SELECT AppointmentID % 4 AS batch_id, count(*) AS n FROM streamed GROUP BY ALL)
        SELECT batch_id, events, CAST(0 AS BIGINT) AS unreadable,
          CASE WHEN batch_id % 2 = 0 THEN n ELSE 0 END AS usable,
          CASE WHEN batch_id % 2 = 0 THEN n END AS written
        FROM seen LEFT JOIN kept USING (batch_id)""",
    "stream_replayed": f"""WITH {STREAMED}
        SELECT *, AppointmentID % 3 AS batch,
          CASE WHEN AppointmentID % 3 = 2 THEN 2 ELSE 1 END AS model FROM streamed""",
    "stream_damaged_events": f"""WITH {STREAMED}, {DAMAGED}
        SELECT form, AppointmentID, outcome FROM damaged
        CROSS JOIN (VALUES ('batches'), ('files')) AS forms(form)""",
    "stream_damaged_counts": f"""WITH {STREAMED}, {DAMAGED}
        SELECT form, (SELECT count(*) FROM raw) AS events,
          count(*) FILTER (outcome = 'unreadable') AS unreadable,
          count(*) FILTER (outcome = 'scored') AS usable
        FROM damaged CROSS JOIN (VALUES ('batches'), ('files')) AS forms(form) GROUP BY form""",
    "stream_triggered": f"""WITH {STREAMED}
        SELECT 1 AS on_time, count(*) AS "rows", CAST(3 AS BIGINT) AS batches FROM streamed""",
    "model_settings": f"""WITH {SPLIT_TRAINING},
        train AS (SELECT * FROM split_rows WHERE split = 'train'),
        sized AS (SELECT CAST(count(*) AS DOUBLE) AS n,
          CAST(least(greatest(32, {_widest()}), 10000) AS DOUBLE) AS splits FROM train)
        {_settings()}""",
    "batch_inference_checked": f"WITH {SCORING} SELECT *, {HOLDS} FROM scoring",
    "stream_inference_checked": f"WITH {STREAMED} SELECT *, {HOLDS} FROM streamed",
    "stream_file_sink_checked": f"WITH {STREAMED} SELECT *, {HOLDS} FROM streamed",
}
