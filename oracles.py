"""DuckDB statements with the same result as the registered queries, over the same tables.

Means, ratios and the like are compared in single precision, where the order of summation does not show.
"""

EPISODES = r"""
WITH episodes AS (
    SELECT
        ts AS "timestamp",
        CASE WHEN event_type <> 'error' THEN value END AS "P-PDG",
        CASE WHEN event_type <> 'purchase' THEN value + 10 END AS "P-MON-CKP",
        CAST(NULL AS DOUBLE) AS "P-JUS-CKP",
        CASE WHEN value >= 20 THEN value * 2 END AS "P-TPT",
        CASE WHEN event_type <> 'click' THEN value / 4 END AS "T-TPT",
        CASE WHEN value <= 60 THEN value * 8 END AS "QGL",
        CASE WHEN event_type <> 'signup' THEN value - 1 END AS "T-JUS-CKP",
        CAST(CASE event_type WHEN 'click' THEN 0 WHEN 'error' THEN 8 WHEN 'purchase' THEN 3 WHEN 'signup' THEN 101 END
            AS INTEGER) AS state,
        CASE
            WHEN value < 3 THEN '/episodes/DRAWN_00001.parquet'
            WHEN value >= 150 THEN '/episodes/SIMULATED_00001.parquet'
            ELSE '/episodes/WELL-' || lpad(CAST(user_id AS VARCHAR), 5, '0') || '_' || strftime(ts, '%Y%m')
                || CAST((day(ts) - 1) // 10 AS VARCHAR) || '.parquet'
        END AS source_file
    FROM events
)"""

OBSERVATIONS = EPISODES + r""",
tagged AS (
    SELECT
        *,
        contains(source_file, 'DRAWN') AS is_drawn,
        contains(source_file, 'SIMULATED') AS is_simulated,
        TRY_CAST(nullif(regexp_extract(source_file, 'WELL-(\d+)', 1), '') AS INTEGER) AS well_number
    FROM episodes
),
obs AS (
    SELECT * FROM tagged
    WHERE state IS NOT NULL AND "timestamp" IS NOT NULL AND NOT is_drawn AND NOT is_simulated
)"""

STATE_NAME = """CASE state WHEN 0 THEN 'Normal' WHEN 1 THEN 'Abrupt Increase of BSW'
    WHEN 2 THEN 'Spurious Closure of DHSV' WHEN 3 THEN 'Severe Slugging' WHEN 4 THEN 'Flow Instability'
    WHEN 5 THEN 'Rapid Productivity Loss' WHEN 6 THEN 'Quick Restriction in PCK' WHEN 7 THEN 'Scaling in PCK'
    WHEN 8 THEN 'Hydrate in Production Line' END"""

SENSORS = ["P-PDG", "P-MON-CKP", "P-JUS-CKP", "P-TPT", "T-TPT", "QGL", "T-JUS-CKP"]
MODEL_TAGS = ["P-PDG", "P-TPT", "T-TPT", "P-MON-CKP", "T-JUS-CKP", "QGL"]
FILLED = SENSORS + ["state", "source_file", "is_drawn", "is_simulated"]
LATEST = 'well_number, "timestamp", "T-JUS-CKP", "T-TPT", "P-TPT", "P-MON-CKP", "P-PDG", "QGL"'
RECENT = 'well_number, state, "timestamp", "T-JUS-CKP", "T-TPT", "P-TPT", "P-MON-CKP", "P-PDG", source_file'


def _fill(columns, partition, kept):
    so_far = f'PARTITION BY {partition} ORDER BY "timestamp", source_file ROWS UNBOUNDED PRECEDING'
    filled = ", ".join(f'last_value("{c}" IGNORE NULLS) OVER ({so_far}) AS "{c}"' for c in columns)
    return f'SELECT {kept}, {filled} FROM obs'


def _fill_short_gaps(hours):
    so_far = 'PARTITION BY well_number ORDER BY "timestamp", source_file ROWS UNBOUNDED PRECEDING'
    filled = ", ".join(
        f'CASE WHEN "timestamp" <= last_value(CASE WHEN "{c}" IS NOT NULL THEN "timestamp" END IGNORE NULLS)'
        f' OVER ({so_far}) + INTERVAL {hours} HOUR THEN last_value("{c}" IGNORE NULLS) OVER ({so_far}) END AS "{c}"'
        for c in FILLED
    )
    return f'SELECT well_number, "timestamp", {filled} FROM obs'


def _newest(columns, partition, n, source="obs"):
    return f"""SELECT {columns} FROM (
        SELECT *, row_number() OVER (PARTITION BY {partition} ORDER BY "timestamp" DESC, source_file) AS nth
        FROM {source}
    ) WHERE nth <= {n}"""



def _capped(n, source="obs"):
    return f"""SELECT {LATEST} FROM (
        SELECT *, row_number() OVER (PARTITION BY well_number ORDER BY "timestamp" DESC, source_file) AS nth
        FROM {source} ORDER BY "timestamp" DESC, source_file LIMIT 1000
    ) WHERE nth <= {n}"""


def _unpivot(tags, extra):
    return " UNION ALL ".join(
        f"""SELECT {extra}, '{t}' AS tag, "{t}" AS value FROM obs""" for t in tags
    )


SPLIT = """
keyed AS (
    SELECT *, md5('42|' || CAST(well_number AS VARCHAR) || '|' || CAST("timestamp" AS VARCHAR) || '|' || source_file)
        AS hashed
    FROM obs
),
split AS (
    SELECT * EXCLUDE (hashed), row_number() OVER (PARTITION BY state ORDER BY hashed)
        <= round(CAST(0.2 AS DOUBLE) * count(*) OVER (PARTITION BY state)) AS is_test
    FROM keyed
)"""

SCORED = """
scored AS (
    SELECT state AS label,
        CASE WHEN coalesce("P-PDG", 0) > 60 THEN 8 WHEN coalesce("P-TPT", 0) > 80 THEN 3 ELSE 0 END AS prediction,
        1 / (1 + coalesce("P-PDG", 0)) AS score_0, coalesce("P-TPT", 0) / 1000 AS score_3,
        coalesce("P-PDG", 0) / 1000 AS score_8, coalesce("QGL", 0) / 1000 AS score_101
    FROM obs
)"""

REPORT = """
classes AS (SELECT label AS class FROM scored UNION SELECT prediction FROM scored),
counted AS (
    SELECT class,
        (SELECT count(*) FROM scored WHERE label = class) AS support,
        (SELECT count(*) FROM scored WHERE prediction = class) AS predicted,
        (SELECT count(*) FROM scored WHERE label = class AND prediction = class) AS hits
    FROM classes
),
per_class AS (
    SELECT class, support, hits,
        CASE WHEN predicted = 0 THEN 0.0 ELSE hits / CAST(predicted AS DOUBLE) END AS p,
        CASE WHEN support = 0 THEN 0.0 ELSE hits / CAST(support AS DOUBLE) END AS r,
        CASE WHEN support + predicted = 0 THEN 0.0 ELSE 2 * hits / CAST(support + predicted AS DOUBLE) END AS f
    FROM counted
),
report AS (
    SELECT 'State_' || CAST(class AS VARCHAR) AS class_name, p, r, f, support FROM per_class
    UNION ALL
    SELECT 'accuracy', NULL, NULL, sum(hits) / CAST(sum(support) AS DOUBLE), sum(support) FROM per_class
    UNION ALL
    SELECT 'macro avg', avg(p), avg(r), avg(f), sum(support) FROM per_class
    UNION ALL
    SELECT 'weighted avg', sum(p * support) / sum(support), sum(r * support) / sum(support),
        sum(f * support) / sum(support), sum(support)
    FROM per_class
)"""

AUC = """
long AS (
    SELECT 0 AS class, score_0 AS score, label = 0 AS positive FROM scored
    UNION ALL SELECT 3, score_3, label = 3 FROM scored
    UNION ALL SELECT 8, score_8, label = 8 FROM scored
    UNION ALL SELECT 101, score_101, label = 101 FROM scored
),
ranked AS (
    SELECT *, rank() OVER (PARTITION BY class ORDER BY score)
        + (count(*) OVER (PARTITION BY class, score) - 1) / CAST(2 AS DOUBLE) AS mid_rank
    FROM long
),
sums AS (
    SELECT class, sum(CASE WHEN positive THEN mid_rank END) AS ranks,
        CAST(count(*) FILTER (WHERE positive) AS DOUBLE) AS p, CAST(count(*) FILTER (WHERE NOT positive) AS DOUBLE) AS n
    FROM ranked GROUP BY class
),
aucs AS (SELECT class, p, n, (ranks - p * (p + 1) / 2) / (p * n) AS auc FROM sums)"""

LISTING = r"""
WITH pages_at AS (
    SELECT page_id, url, regexp_extract(url, '://([^/]+)', 1) AS host, length(html) AS size,
        'page-' || lpad(CAST(page_id AS VARCHAR), 9, '0')
            || CASE WHEN url LIKE '%.html' THEN '.html' ELSE '.parquet' END AS name
    FROM pages
),
hosts AS (
    SELECT DISTINCT host, CASE WHEN host LIKE 'www.%' THEN 'file' ELSE 'dir' END AS type FROM pages_at
)"""


def _manifest(max_dirs=None, max_files=None):
    dirs = f" ORDER BY host LIMIT {max_dirs}" if max_dirs else ""
    files = f" ORDER BY host, name LIMIT {max_files}" if max_files else ""
    return LISTING + f""",
dirs AS (SELECT host FROM (SELECT * FROM hosts{dirs}) WHERE type = 'dir'),
manifest AS (
    SELECT host AS subdir, name, host || '/' || name AS path, url AS download_url, size,
        NOT (url LIKE 'http://%') AS is_new
    FROM pages_at WHERE host IN (SELECT host FROM dirs) AND name LIKE '%.parquet'{files}
)"""


TRACES = r"""
WITH traces AS (
    SELECT conv_id, turn, CAST(conv_id AS VARCHAR) AS run_id,
        CAST(conv_id AS VARCHAR) || '-' || lpad(CAST(turn AS VARCHAR), 6, '0') AS trace_id,
        CASE WHEN role = 'assistant' THEN len(string_split(text, chr(10))) ELSE 0 END AS calls,
        length(text) / CAST(100 AS DOUBLE) AS seconds
    FROM conversations
)"""

TIMED = """run_id, trace_id, seconds AS response_time, CASE WHEN seconds <= 5 THEN 'yes' ELSE 'no' END AS value,
    printf('LLM response time %.2fs ', seconds) || CASE WHEN seconds <= 5 THEN 'is within' ELSE 'exceeds' END
        || ' the 5.0s limit.' AS rationale"""

VERDICT = """CASE WHEN num_tool_calls > 0 THEN 'yes' ELSE 'no' END AS value,
    CASE WHEN num_tool_calls > 0 THEN 'Tools were called' ELSE 'No tools were called' END AS rationale"""

NEWEST_PER_WELL = _newest(LATEST, "well_number", 5)

FAILURE_COUNTS = OBSERVATIONS + f"""
SELECT well_number, {STATE_NAME} AS failure_type, count(*) AS failure_count FROM obs GROUP BY well_number, state"""

TIME_BOUNDS = OBSERVATIONS + """
SELECT well_number, min("timestamp") AS min_timestamp, max("timestamp") AS max_timestamp FROM obs GROUP BY well_number"""

FILLED_TABLE = OBSERVATIONS + ", filled AS (" + _fill(FILLED, "well_number", 'well_number, "timestamp"') + ") "

FORWARD_FILL = OBSERVATIONS + _fill(FILLED, "well_number", 'well_number, "timestamp"')

ORACLES = {
    "clean_observations": OBSERVATIONS + "SELECT * FROM obs",
    "clean_keep_synthetic": OBSERVATIONS + """
        SELECT * FROM tagged WHERE state IS NOT NULL AND "timestamp" IS NOT NULL""",
    "normalised_episodes": EPISODES + """
        SELECT * REPLACE (date_trunc('milliseconds', "timestamp") AS "timestamp"),
            CAST(NULL AS DOUBLE) AS "P-MON-CKGL", CAST(NULL AS DOUBLE) AS "P-JUS-CKGL"
        FROM episodes WHERE state IS NOT NULL""",
    "united_files": """
        SELECT c_custkey, c_name, 'customer.parquet' AS file_name FROM customer
        UNION ALL BY NAME
        SELECT s_suppkey, s_name, 'supplier.parquet' AS file_name FROM supplier""",
    "ingest_manifest": _manifest() + "SELECT * FROM manifest",
    "ingest_manifest_capped": _manifest(20, 40) + "SELECT * FROM manifest",
    "ingest_new_files": _manifest() + "SELECT * EXCLUDE (is_new) FROM manifest WHERE is_new",
    "ingest_report": _manifest() + """
        SELECT count(*) AS processed_files, count(*) FILTER (WHERE NOT is_new) AS skipped_files,
            count(*) FILTER (WHERE is_new) AS new_files,
            CAST(coalesce(sum(size) FILTER (WHERE is_new), 0) AS BIGINT) AS new_bytes
        FROM manifest""",
    "tags_long": OBSERVATIONS + f""",
        long AS ({_unpivot(SENSORS, 'well_number, "timestamp"')}),
        dictionary (tag_id, tag, name, unit) AS (VALUES
            (1, 'P-PDG', 'Pressure at the PDG', 'Pa'),
            (2, 'P-TPT', 'Pressure at the TPT', 'Pa'),
            (3, 'T-TPT', 'Temperature at the TPT', 'degC'),
            (4, 'P-MON-CKP', 'Pressure upstream of the PCK', 'Pa'),
            (5, 'T-JUS-CKP', 'Temperature downstream of the PCK', 'degC'),
            (6, 'P-JUS-CKGL', 'Pressure downstream of the GLCK', 'Pa'),
            (7, 'QGL', 'Gas lift flow rate', 'sm^3/s'))
        SELECT long.*, tag_id, name, unit FROM long LEFT JOIN dictionary USING (tag)""",
    "model_columns": OBSERVATIONS + """
        SELECT "timestamp", "P-PDG", "P-TPT", "T-TPT", "P-MON-CKP", "T-JUS-CKP", "QGL", well_number, state FROM obs""",
    "well_filter": OBSERVATIONS + "SELECT * FROM obs WHERE well_number IN (19, 29, 31, 28, 25)",
    "one_well": OBSERVATIONS + "SELECT * FROM obs WHERE well_number = 19",
    "state_name": OBSERVATIONS + f"""
        SELECT well_number, "timestamp", state, coalesce({STATE_NAME}, 'Unknown') AS state_name FROM obs""",
    "state_name_nullable": EPISODES + f"""
        SELECT "timestamp", state, {STATE_NAME} AS state_name FROM episodes""",
    "null_census": EPISODES + "SELECT " + ", ".join(
        f'CAST(count(*) FILTER (WHERE "{c}" IS NULL) AS BIGINT) AS "{c}"'
        for c in ["timestamp", *SENSORS, "state", "source_file"]
    ) + " FROM episodes",
    "well_failure_counts": FAILURE_COUNTS,
    "well_time_bounds": TIME_BOUNDS,
    "profile": OBSERVATIONS + """
        SELECT count(*) AS n_rows, CAST(13 AS INTEGER) AS n_columns, count(DISTINCT well_number) AS n_wells,
            count(DISTINCT state) AS n_states, min("timestamp") AS min_timestamp, max("timestamp") AS max_timestamp
        FROM obs""",
    "forward_fill": FORWARD_FILL,
    "forward_fill_by_file": OBSERVATIONS + _fill(
        [c for c in FILLED if c != "source_file"], "well_number, source_file", 'well_number, "timestamp", source_file'
    ),
    "forward_fill_in_days": FORWARD_FILL,
    "forward_fill_short_gaps": OBSERVATIONS + _fill_short_gaps(12),
    "latest_n_obs": OBSERVATIONS + NEWEST_PER_WELL,
    "latest_n_obs_capped": OBSERVATIONS + _capped(5),
    "latest_n_obs_uncapped": OBSERVATIONS + NEWEST_PER_WELL,
    "latest_n_obs_one_well": OBSERVATIONS + _newest(LATEST, "well_number", 10) + " AND well_number = 19",
    "latest_filled": FILLED_TABLE + _newest(LATEST, "well_number", 5, "filled"),
    "most_recent_obs": OBSERVATIONS + _newest(RECENT, "well_number, state", 1),
    "sql_latest_n_obs": FILLED_TABLE + _newest(LATEST, "well_number", 5, "filled"),
    "sql_latest_n_obs_capped": FILLED_TABLE + _capped(5, "filled"),
    "sql_latest_n_obs_many": FILLED_TABLE + _newest(LATEST, "well_number", 2000, "filled"),
    "sql_latest_n_obs_uncapped": FILLED_TABLE + _newest(LATEST, "well_number", 3, "filled"),
    "sql_most_recent_obs": FILLED_TABLE + _newest(RECENT, "well_number, state", 1, "filled") + " AND well_number = 19",
    "sql_most_recent_obs_all": FILLED_TABLE + _newest(RECENT, "well_number, state", 1, "filled"),
    "sql_predict_state_rule": FILLED_TABLE + f"""
        SELECT well_number, "timestamp", CAST(CASE WHEN coalesce("P-PDG", 0) > 60 THEN 8
            WHEN coalesce("P-TPT", 0) > 80 THEN 3 ELSE 0 END AS INTEGER) AS prediction
        FROM ({_newest(LATEST, "well_number", 10, "filled")})""",
    "sql_well_time_bounds": TIME_BOUNDS,
    "sql_well_failure_counts": FAILURE_COUNTS,
    "sort_series": OBSERVATIONS + 'SELECT * FROM obs ORDER BY well_number, "timestamp"',
    "newest_rows": OBSERVATIONS + 'SELECT * FROM obs ORDER BY "timestamp" DESC LIMIT 1000',
    "top_k": OBSERVATIONS + 'SELECT * FROM obs ORDER BY "P-PDG" DESC NULLS LAST, "timestamp" LIMIT 10',
    "row_range": OBSERVATIONS + """
        SELECT "timestamp", "P-PDG", "P-TPT", "T-TPT", "P-MON-CKP", "T-JUS-CKP", "QGL", well_number, state
        FROM obs ORDER BY "timestamp" LIMIT 4 OFFSET 5""",
    "seeded_sample": OBSERVATIONS + """
        SELECT * FROM obs
        ORDER BY md5('42|' || CAST(well_number AS VARCHAR) || '|' || CAST("timestamp" AS VARCHAR)) LIMIT 5""",
    "stratified_split": OBSERVATIONS + "," + SPLIT + "SELECT * FROM split",
    "split_by_time": OBSERVATIONS + """
        SELECT *, "timestamp" >= TIMESTAMP '2024-01-25 00:00:00' AS is_test FROM obs""",
    "split_classes": OBSERVATIONS + "," + SPLIT + """
        SELECT is_test, count(*) AS n_rows, count(DISTINCT state) AS n_classes FROM split GROUP BY is_test""",
    "series_features": OBSERVATIONS + f""",
        long AS ({_unpivot(MODEL_TAGS, 'well_number')})
        SELECT well_number, tag, CAST(CAST(sum(value) AS FLOAT) AS DOUBLE) AS sum_values, CAST(CAST(median(value) AS FLOAT) AS DOUBLE) AS median,
            CAST(CAST(avg(value) AS FLOAT) AS DOUBLE) AS mean, count(value) AS length, CAST(CAST(stddev_pop(value) AS FLOAT) AS DOUBLE) AS standard_deviation,
            CAST(CAST(var_pop(value) AS FLOAT) AS DOUBLE) AS variance, CAST(CAST(sqrt(avg(value * value)) AS FLOAT) AS DOUBLE) AS root_mean_square,
            CAST(CAST(max(value) AS FLOAT) AS DOUBLE) AS maximum, CAST(CAST(max(abs(value)) AS FLOAT) AS DOUBLE) AS absolute_maximum,
            CAST(CAST(min(value) AS FLOAT) AS DOUBLE) AS minimum
        FROM long GROUP BY well_number, tag""",
    "confusion_counts": OBSERVATIONS + "," + SCORED + """
        SELECT label, prediction, count(*) AS n FROM scored GROUP BY label, prediction""",
    "accuracy": OBSERVATIONS + "," + SCORED + """
        SELECT count(*) FILTER (WHERE label = prediction) / CAST(count(*) AS DOUBLE) AS accuracy FROM scored""",
    "class_report": OBSERVATIONS + "," + SCORED + "," + REPORT + """
        SELECT class_name, CAST(CAST(p AS FLOAT) AS DOUBLE) AS precision, CAST(CAST(r AS FLOAT) AS DOUBLE) AS recall, CAST(CAST(f AS FLOAT) AS DOUBLE) AS f1_score,
            CAST(support AS BIGINT) AS support
        FROM report""",
    "ovr_auc": OBSERVATIONS + "," + SCORED + "," + AUC + """
        SELECT class, CAST(p AS BIGINT) AS positives, CAST(n AS BIGINT) AS negatives, CAST(CAST(auc AS FLOAT) AS DOUBLE) AS auc FROM aucs""",
    "weighted_ovr_auc": OBSERVATIONS + "," + SCORED + "," + AUC + """
        SELECT CAST(CAST(sum(auc * p) / sum(p) AS FLOAT) AS DOUBLE) AS weighted_auc, CAST(NULL AS VARCHAR) AS message FROM aucs""",
    "tools_called": TRACES + f"""
        SELECT run_id, trace_id, num_tool_calls, {VERDICT}
        FROM (SELECT *, CAST(calls AS INTEGER) AS num_tool_calls FROM traces)""",
    "tool_calls_per_conversation": TRACES + f"""
        SELECT run_id, num_tool_calls, {VERDICT}
        FROM (SELECT run_id, CAST(sum(calls) AS BIGINT) AS num_tool_calls FROM traces GROUP BY run_id)""",
    "response_time_good": TRACES + f"SELECT {TIMED} FROM traces",
    "first_trace": TRACES + f"""
        SELECT {TIMED} FROM (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY turn DESC) AS nth FROM traces)
        WHERE nth = 1""",
    "traces_of_run": TRACES + f"SELECT {TIMED} FROM traces WHERE run_id = '7'",
    "evaluation_requests": """
        SELECT conv_id, turn, 'user' AS role, text AS content, CAST(1 AS INTEGER) AS n_messages
        FROM conversations WHERE role = 'user'""",
    "json_props": """
        SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events""",
}
ORACLES["series_features_bracketed"] = ORACLES["series_features"]
_CUT = """SELECT * EXCLUDE (source_file) REPLACE (date_trunc('milliseconds', "timestamp") AS "timestamp") FROM """
ORACLES["episode_files"] = EPISODES + _CUT + "episodes WHERE state IS NOT NULL"
ORACLES["raw_files"] = EPISODES + f"""
    SELECT * EXCLUDE (source_file) REPLACE (date_trunc('milliseconds', "timestamp") AS "timestamp"),
        CAST(NULL AS DOUBLE) AS "P-MON-CKGL", CAST(NULL AS DOUBLE) AS "P-JUS-CKGL"
    FROM episodes WHERE state IS NOT NULL"""
ORACLES["ingested_rows"] = ORACLES["episode_files"]
ORACLES["episode_table"] = FILLED_TABLE + _CUT + "filled"
ORACLES["process_tree"] = OBSERVATIONS + f"""
    SELECT well_number, date_trunc('milliseconds', "timestamp") AS "timestamp", state,
        coalesce({STATE_NAME}, 'Unknown') AS state_name FROM obs"""
ORACLES["ovr_auc_sliced"] = ORACLES["ovr_auc"]
ORACLES["latest_n_obs_pruned"] = ORACLES["latest_n_obs_uncapped"]
ORACLES["most_recent_obs_pruned"] = ORACLES["most_recent_obs"]

# Models are trained on rows in which the features decide the label, so that a right model predicts the label itself: which
# sensor is missing in rows that are not filled, or a pressure in steps of ten.
GRADED = FILLED_TABLE.rstrip() + """,
graded AS (
    SELECT * EXCLUDE (state) REPLACE (floor("P-PDG" / 10) * 10.0 AS "P-PDG"),
        CASE WHEN floor("P-PDG" / 10) >= 6 THEN 8 WHEN floor("P-PDG" / 10) >= 3 THEN 3 ELSE 0 END AS state
    FROM filled WHERE "P-PDG" IS NOT NULL
)"""
_GRADED_SPLIT = GRADED + "," + SPLIT.replace("FROM obs", "FROM graded")
_BARE_SPLIT = OBSERVATIONS + "," + SPLIT
_RIGHT = """,
scored AS (
    SELECT state AS label, state AS prediction, CAST(state = 0 AS INTEGER) AS score_0, CAST(state = 3 AS INTEGER) AS score_3,
        CAST(state = 8 AS INTEGER) AS score_8, CAST(state = 101 AS INTEGER) AS score_101
    FROM split WHERE is_test
),"""
_report_of = lambda split: split + _RIGHT + ORACLES["class_report"].split(SCORED + ",")[1]
_auc_of = lambda split: split + _RIGHT + ORACLES["weighted_ovr_auc"].split(SCORED + ",")[1]
_newest_of = lambda table, source: table + f"""
    SELECT well_number, "timestamp", CAST(state AS INTEGER) AS prediction
    FROM ({_newest(LATEST + ", state", "well_number", 10, source)})"""
ORACLES |= {
    "predict_state": _newest_of(GRADED, "graded"),
    "sql_predict_state": _newest_of(GRADED, "graded"),
    "sql_predict_state_boosted": _newest_of(OBSERVATIONS, "obs"),
    "boosted_predictions": _BARE_SPLIT + 'SELECT well_number, "timestamp", state AS prediction FROM split WHERE is_test',
    "boosted_report": _report_of(_BARE_SPLIT),
    "boosted_auc": _auc_of(_BARE_SPLIT),
    "boosted_importance": GRADED + "SELECT 'P-PDG' AS feature, CAST(1 AS DOUBLE) AS importance FROM graded LIMIT 1",
    "feature_importance": GRADED + "SELECT 'P-PDG' AS feature FROM graded LIMIT 1",
    "model_report": _report_of(_GRADED_SPLIT),
    "model_auc": _auc_of(_GRADED_SPLIT),
}
