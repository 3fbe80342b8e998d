import pytest
from pyspark.sql import functions as F

CLASHING = ("key", "id", "n", "row", "h", "kept", "score", "found", "band", "hub", "path", "blob", "spans", "words",
            "matches", "windows", "drops", "draw", "digest", "text_sha256", "component_id", "shard", "label", "block")


@pytest.fixture(scope="session")
def frame(spark):
    """Documents of (doc_id, text), with columns whose names the operators use themselves."""

    def make(rows, column="doc_id"):
        docs = spark.createDataFrame(list(rows), f"{column} long, text string")
        return docs.withColumns({c: F.lit("clash") for c in CLASHING})

    return make
