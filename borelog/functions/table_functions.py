"""SQL surface: table functions over a view or table of observations, callable by position or by name."""

from pyspark.sql import SparkSession

from borelog.operators.newest import GROUP_LIMIT, GROUP_PARTS, LATEST_COLUMNS, RECENT_COLUMNS
from borelog.schema import MODEL_FEATURES, STATE_NAMES

# Names, parameters and defaults of the functions below.
WELL_COMMENT = "Well number, a whole number; -1 takes all wells"


def register_functions(
    spark: SparkSession,
    observations: str = "well_data",
    model_function: str | None = None,
    scan_cap: int | None = None,
    temporary: bool = True,
    schema: str | None = None,
) -> None:
    """Create ``state_name`` and the table functions that read the view or table ``observations``.

    ``latest_n_obs(well, n)``, ``most_recent_obs(well)``, ``well_time_bounds(well)``, ``well_failure_counts(well)``
    and, given the name of a function of the array of model features, ``predict_state(well, n)``. ``scan_cap``, if any, is
    fixed at creation, because SQL takes no parameter in LIMIT. Ties in time go by ``source_file``, then by row content.
    Beyond GROUP_LIMIT rows per well ``latest_n_obs`` ranks in parts of a well first, and then what is left of them, so that no
    task sorts a whole well. Functions that are not ``temporary`` go into ``schema`` and need
    a table and a model function that are permanent too; Spark calls table functions without a qualifier, so ``USE`` the
    schema first. Bodies are inlined into the calling query, so a constant well
    number reaches the Parquet scan as a pushed filter and -1 leaves no filter behind.
    """
    types = {field.name: field.dataType.simpleString() for field in spark.table(observations).schema}
    create = f"CREATE OR REPLACE {'TEMPORARY ' if temporary else ''}FUNCTION"
    home = f"{schema}." if schema else ""
    well = f"well_number_param BIGINT DEFAULT -1 COMMENT '{WELL_COMMENT}'"
    chosen = f"{observations} WHERE well_number_param = -1 OR well_number = well_number_param"
    names = ", ".join(f"'{name}'" for name in STATE_NAMES)

    def columns(listed):
        return ", ".join(f"`{c}` {types[c]}" for c in listed)

    def listing(listed):
        return ", ".join(f"`{c}`" for c in listed)

    spark.sql(f"{create} {home}state_name(code INT) RETURNS STRING RETURN get(array({names}), code)")
    newest_first = f"timestamp DESC, source_file, xxhash64({listing(types)})"
    cap = "" if scan_cap is None else f"ORDER BY {newest_first} LIMIT {scan_cap}"
    spark.sql(f"""
        {create} {home}latest_n_obs({well}, n_obs_param INT DEFAULT 5 COMMENT 'How many observations per well')
        RETURNS TABLE ({columns(LATEST_COLUMNS)})
        COMMENT 'The newest n observations of a well, or of every well'
        RETURN
        WITH newest AS (
            SELECT *, IF(n_obs_param <= {GROUP_LIMIT}, 0, pmod(xxhash64({listing(types)}, spark_partition_id()), {GROUP_PARTS})) AS part
            FROM (SELECT * FROM {chosen} {cap})
        ),
        of_part AS (
            SELECT *, row_number() OVER (PARTITION BY well_number, part ORDER BY {newest_first}) AS nth_of_part
            FROM newest
        ),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY well_number ORDER BY {newest_first}) AS nth
            FROM of_part WHERE nth_of_part <= n_obs_param
        )
        SELECT {listing(LATEST_COLUMNS)} FROM ranked WHERE nth <= n_obs_param
    """)
    spark.sql(f"""
        {create} {home}most_recent_obs({well}) RETURNS TABLE ({columns(RECENT_COLUMNS)})
        COMMENT 'The newest observation of each state of a well, or of every well'
        RETURN
        WITH ranked AS (
            SELECT *, row_number() OVER (PARTITION BY well_number, state ORDER BY {newest_first}) AS nth
            FROM {chosen}
        )
        SELECT {listing(RECENT_COLUMNS)} FROM ranked WHERE nth = 1
    """)
    spark.sql(f"""
        {create} {home}well_time_bounds({well})
        RETURNS TABLE (well_number INT, min_timestamp {types['timestamp']}, max_timestamp {types['timestamp']})
        COMMENT 'First and last time seen of a well, or of every well'
        RETURN SELECT well_number, min(timestamp), max(timestamp) FROM {chosen} GROUP BY well_number
    """)
    spark.sql(f"""
        {create} {home}well_failure_counts({well})
        RETURNS TABLE (well_number INT, failure_type STRING, failure_count BIGINT)
        COMMENT 'Observations per state of a well, or of every well'
        RETURN
        WITH counts AS (SELECT well_number, state, count(*) AS n FROM {chosen} GROUP BY well_number, state)
        SELECT well_number, get(array({names}), state), n FROM counts
    """)
    if model_function is not None:
        features = ", ".join(f"CAST(`{c}` AS DOUBLE)" for c in MODEL_FEATURES)
        spark.sql(f"""
            {create} {home}predict_state(
                {well.replace('BIGINT', 'INT')}, n_obs_param INT DEFAULT 10 COMMENT 'How many observations per well'
            )
            RETURNS TABLE (well_number INT, timestamp {types['timestamp']}, prediction INT)
            COMMENT 'Predicted state of the newest observations of a well, or of every well'
            RETURN SELECT well_number, timestamp, CAST({model_function}(array({features})) AS INT)
            FROM latest_n_obs(well_number_param, n_obs_param)
        """)
