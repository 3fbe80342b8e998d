"""Column names, types and the fixed dictionaries of the data model."""

from pyspark.sql import types as T

# State codes, sensor tags, the tag dictionary, the training wells and the path patterns.
STATE_NAMES = (
    "Normal",
    "Abrupt Increase of BSW",
    "Spurious Closure of DHSV",
    "Severe Slugging",
    "Flow Instability",
    "Rapid Productivity Loss",
    "Quick Restriction in PCK",
    "Scaling in PCK",
    "Hydrate in Production Line",
)
SENSORS = ("P-PDG", "P-MON-CKP", "P-JUS-CKP", "P-TPT", "T-TPT", "QGL", "T-JUS-CKP")
RAW_COLUMNS = (
    "P-PDG", "P-MON-CKP", "P-MON-CKGL", "P-JUS-CKGL", "P-JUS-CKP", "P-TPT", "T-TPT", "QGL", "T-JUS-CKP",
    "state", "timestamp",
)
MODEL_TAGS = ("P-PDG", "P-TPT", "T-TPT", "P-MON-CKP", "T-JUS-CKP", "QGL")
TAG_DICTIONARY = (
    (1, "P-PDG", "Pressure at the PDG", "Pa"),
    (2, "P-TPT", "Pressure at the TPT", "Pa"),
    (3, "T-TPT", "Temperature at the TPT", "degC"),
    (4, "P-MON-CKP", "Pressure upstream of the PCK", "Pa"),
    (5, "T-JUS-CKP", "Temperature downstream of the PCK", "degC"),
    (6, "P-JUS-CKGL", "Pressure downstream of the GLCK", "Pa"),
    (7, "QGL", "Gas lift flow rate", "sm^3/s"),
)
TRAINING_WELLS = (19, 29, 31, 28, 25)
WELL_PATTERN = r"WELL-(\d+)"
DRAWN_MARK = "DRAWN"
SIMULATED_MARK = "SIMULATED"
ALL_WELLS = -1
SCAN_CAP = 1000

MODEL_FEATURES = MODEL_TAGS + ("well_number",)

EPISODE_SCHEMA = T.StructType(
    [T.StructField("timestamp", T.TimestampType())]
    + [T.StructField(tag, T.DoubleType()) for tag in SENSORS]
    + [T.StructField("state", T.IntegerType())]
)

LISTING_SCHEMA = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("download_url", T.StringType()),
    T.StructField("size", T.LongType()),
    T.StructField("subdir", T.StringType()),
    T.StructField("type", T.StringType()),
])

MESSAGE_TYPE = "struct<role: string, content: string, tool_calls: array<struct<name: string, arguments: string>>>"
SPANS_TYPE = (
    f"array<struct<start_time_ns: bigint, end_time_ns: bigint, outputs: struct<messages: array<{MESSAGE_TYPE}>>>>"
)
