"""A corpus pipeline: toxic documents, exact copies, near copies and benchmark leaks go; what stays is encoded.

Every stage takes the documents that the stage before it kept and, but for the last, returns them with their columns. Each
result is written to the shared folder and read back, so a lost executor costs one stage's tasks at most.
"""

from pyspark.sql import DataFrame, functions as F

from borelog.llm import decontamination, exact_dedup, minhash, toxicity
from borelog.llm.queries import token_digests
from borelog.support import materialise


def drop_toxic(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below the threshold. The model learns from those labelled ones that reach the stage."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.where(toxicity.scorer(spark, model)(F.col("text")) < toxicity.THRESHOLD)


def drop_copies(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of identical texts the document with the largest doc_id. Rows that repeat doc_id and text stay together."""
    copies = exact_dedup.exact_dedup(docs).where("NOT kept").select(F.col("doc_id").alias("id"), F.col("text_sha256").alias("sha"))
    same = docs["doc_id"].eqNullSafe(copies["id"]) & (F.sha2(F.coalesce(docs["text"], F.lit("")), 256) == copies["sha"])
    return docs.join(copies, same, "left_anti")


def drop_near_copies(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each near-duplicate group. Rows are told apart by doc_id and text, and those without doc_id stay."""
    near = minhash.near_groups(docs).where("NOT kept").select(F.col("doc_id").alias("id"), F.col("sha").alias("of_text")).distinct()
    same = (docs["doc_id"] == near["id"]) & (minhash.text_sha(docs["text"]) == near["of_text"])
    return docs.join(near, same, "left_anti")


def drop_leaks(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark. Rows are told apart by 128 bits of doc_id and text."""
    row = F.unhex(F.md5(F.concat_ws(":", docs["doc_id"].cast("string"), F.hex(minhash.text_sha(docs["text"])))))
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    leaks = decontamination.find_leaks(docs.select(row.alias("doc_id"), "text"), benchmark).select(F.col("doc_id").alias("leak")).distinct()
    return docs.join(leaks, row == leaks["leak"], "left_anti")


def encode(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number and digests of each document's tokens and of what they decode to."""
    return token_digests(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("near dedup", drop_near_copies),
    ("decontamination", drop_leaks),
    ("encoding", encode),
]

# The toxicity model is trained by numpy, which SQL cannot express; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark, sf_dir: str) -> DataFrame:
    """The stages over the documents table; the result of the last one is not written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = materialise(docs)
    return docs
