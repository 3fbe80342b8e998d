"""Names of state codes."""

from pyspark.sql import Column, DataFrame, functions as F

from borelog.schema import STATE_NAMES

UNKNOWN = "Unknown"


def state_name(code, default: str | None = None) -> Column:
    """Name of a state code; any other code, NULL included, gives ``default``."""
    code = F.col(code) if isinstance(code, str) else code
    name = F.get(F.array(*[F.lit(n) for n in STATE_NAMES]), code.cast("int"))
    return name if default is None else F.coalesce(name, F.lit(default))


def add_state_name(observations: DataFrame, default: str | None = UNKNOWN) -> DataFrame:
    return observations.withColumn("state_name", state_name("state", default))
