"""The registered queries of the text operators and the SQL they are checked against."""

from pyspark.sql import DataFrame, functions as F

from borelog.llm import (
    bpe, centroids, decontamination, exact_dedup, fill_in_middle, license_scan, line_dedup, minhash, quality, secret_scan,
    substring_dedup, toxicity, url_filter,
)
from borelog.llm.oracles import ORACLES

__all__ = ["ORACLES", "QUERIES"]


def documents(spark, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def token_digests(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    encoded = bpe.encode_documents(docs, public_tokenizers.path("word_bpe_49k.json"))
    n_tokens = (F.octet_length("ids") / 4).cast("long").alias("n_tokens")
    return encoded.select("doc_id", n_tokens, F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op1_bpe(spark, sf_dir):
    return token_digests(documents(spark, sf_dir))


def op2_line_dedup(spark, sf_dir):
    docs, index = documents(spark, sf_dir), line_dedup.LineIndex(spark)
    for batch in range(2):  # the second one asks the filters of the first
        index.insert(docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(2)) == batch))
    return index.resolve(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op3_decontamination(spark, sf_dir):
    return decontamination.find_leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op4_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_dedup(documents(spark, sf_dir))


def op5_toxicity(spark, sf_dir):
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = toxicity.score(docs, toxicity.fit(docs, labels))
    predicted = F.when(F.col("score") >= toxicity.THRESHOLD, 1).otherwise(0).alias("predicted")
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", predicted)


def op6_minhash(spark, sf_dir):
    return minhash.near_groups(documents(spark, sf_dir)).drop("sha")


def op7_quality(spark, sf_dir):
    return quality.resample(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op8_secret_scan(spark, sf_dir):
    versions = documents(spark, sf_dir).select(F.col("doc_id").alias("path"), "text")
    found = secret_scan.BlobLedger(spark).scan(versions)
    base = [r.kind for r in secret_scan.BASE_RULES]
    count = lambda kind: F.coalesce(F.size(F.filter("spans", lambda s: s["kind"] == kind)), F.lit(0))
    counts = [F.when(F.col("spans").isNull(), 0).otherwise(count(k)).cast("long").alias(f"n_{k}") for k in base]
    of_base = F.filter("spans", lambda s: s["kind"].isin(base))
    return found.select(
        F.col("path").alias("doc_id"), *counts, F.sha2(secret_scan.spans_text(of_base), 256).alias("base_sha256"),
        secret_scan.spans_text(F.col("spans")).alias("spans"),
    )


def op9_substring_dedup(spark, sf_dir):
    kept = substring_dedup.remove_repeats(documents(spark, sf_dir))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op10_license_scan(spark, sf_dir):
    found = license_scan.license_scan(documents(spark, sf_dir))
    return found.select(
        "doc_id", F.size("matches").cast("long").alias("n_licenses"),
        F.array_join(F.transform("matches", lambda m: m["name"]), ",").alias("licenses"),
        F.array_join(F.transform("matches", lambda m: m["start"].cast("string")), ",").alias("starts"),
    )


def op11_fill_in_middle(spark, sf_dir):
    cut = fill_in_middle.fill_in_middle(documents(spark, sf_dir))
    return cut.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fill_in_middle.restored(), 256).alias("restored_sha256"),
    )


def op12_url_filter(spark, sf_dir):
    return url_filter.filter_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op13_centroids(spark, sf_dir):
    found = centroids.cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    # One row per centroid: their sums pass through the driver.
    sums = found.groupBy("cluster").agg(F.try_sum("distance").alias("cluster_inertia")).collect()
    parts = [row.cluster_inertia for row in sums]
    inertia = None if None in parts or sum(parts) >= 1 << 63 else sum(parts)
    rows = [(*row, inertia) for row in sums]
    sums = F.broadcast(spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long"))
    digest = F.sha2(F.array_join(F.transform("centroid", lambda x: x.cast("string")), ","), 256)
    return found.join(sums, "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", digest.alias("centroid_sha256")
    )


QUERIES = {
    "op1_bpe": op1_bpe,
    "op2_line_dedup": op2_line_dedup,
    "op3_decontamination": op3_decontamination,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_toxicity": op5_toxicity,
    "op6_minhash": op6_minhash,
    "op7_quality": op7_quality,
    "op8_secret_scan": op8_secret_scan,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_license_scan": op10_license_scan,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_url_filter": op12_url_filter,
    "op13_centroids": op13_centroids,
}
