"""Secret scans over an incremental ledger of blobs, in DataFrame operations only.

A version of a file is a path and a text. Texts are addressed by their SHA-256, so each content is one blob however many
paths and versions hold it. The ledger says which pairs of blob and rule version have been scanned and what was found;
only pairs that it lacks are scanned, and findings are joined back to all paths.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from borelog.support import folder_exists, materialise, scratch_folder

LEDGER = "blob string, rules string, spans array<struct<start: int, place: int, end: int, kind: string>>"


@dataclass(frozen=True)
class Rule:
    """What one kind of secret looks like; a match stays if its ``group`` has at least ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


# Kinds, patterns and least lengths of the base rules, in their order.
# A run of at least so many characters is found directly where a shorter run cannot hide a longer one.
BASE_RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
BASE_VERSION = "base-1"
# Matches whose positions run in one piece, and the digests of new blobs that may be broadcast: 10 MB.
CHUNK, FEW_BLOBS = 64, 100_000


def _bound(value: Column, use) -> Column:
    """``use`` of a value that is computed once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def _spans(text: str, place: int, rule: Rule) -> Column:
    """Spans of a rule's matches in code points, leftmost and non-overlapping, counted before failing ones are dropped.

    The text between matches and the matches themselves alternate, so running lengths give the positions. They run within
    pieces of CHUNK matches and then over the pieces, so that the work grows with the number of matches.
    """
    pattern = F.lit(rule.pattern)
    found, gaps = F.regexp_extract_all(text, pattern, F.lit(0)), F.split(F.col(text), rule.pattern, -1)
    nothing = F.struct(
        F.lit(0).alias("at"), F.from_json(F.lit("[]"), "array<struct<start: int, end: int, match: string>>").alias("spans")
    )

    def step(state, piece):
        start = state["at"] + F.length(piece["gap"])
        end = start + F.length(piece["match"])
        span = F.struct(start.alias("start"), end.alias("end"), piece["match"].alias("match"))
        return F.struct(end.alias("at"), F.concat(state["spans"], F.array(span)).alias("spans"))

    def whole(pieces):
        numbers = F.sequence(F.lit(0), F.greatest(F.ceil(F.size(pieces) / CHUNK).cast("int") - 1, F.lit(0)))
        chunks = F.transform(numbers, lambda i: F.aggregate(F.slice(pieces, i * CHUNK + 1, F.lit(CHUNK)), nothing, step))
        return _bound(chunks, moved)

    def moved(chunks):
        starts = F.aggregate(chunks, F.array(F.lit(0)), lambda upto, chunk: F.concat(upto, F.array(F.element_at(upto, -1) + chunk["at"])))
        shifted = lambda start: lambda s: F.struct(
            (s["start"] + start).alias("start"), F.lit(place).alias("place"), (s["end"] + start).alias("end"), s["match"].alias("match")
        )
        return _bound(starts, lambda upto: F.flatten(F.transform(chunks, lambda c, i: F.transform(c["spans"], shifted(F.get(upto, i))))))

    spans = _bound(F.arrays_zip(found.alias("match"), F.slice(gaps, 1, F.size(found)).alias("gap")), whole)
    if rule.least:
        spans = F.filter(spans, lambda s: F.length(F.regexp_extract(s["match"], rule.pattern, rule.group)) >= rule.least)
    return F.transform(
        spans, lambda s: F.struct(s["start"].alias("start"), s["place"].alias("place"), s["end"].alias("end"), F.lit(rule.kind).alias("kind"))
    )


def scan_blobs(blobs: DataFrame, rules) -> DataFrame:
    """``blobs`` (text, ...) with ``spans``, by start and then in the order of ``rules``."""
    empty = F.from_json(F.lit("[]"), "array<struct<start: int, place: int, end: int, kind: string>>")
    parts = [F.when(F.col("text").rlike(r.pattern), _spans("text", i, r)).otherwise(empty) for i, r in enumerate(rules)]
    return blobs.withColumn("spans", F.array_sort(F.concat(*parts)))


class BlobLedger:
    """The ledger in a folder that all executors reach."""

    def __init__(self, spark, path: str | None = None):
        self.spark, self.path = spark, path or scratch_folder(spark)

    def read(self) -> DataFrame:
        there = folder_exists(self.spark, self.path)
        return self.spark.read.schema(LEDGER).parquet(self.path) if there else self.spark.createDataFrame([], LEDGER)

    def scan(self, versions: DataFrame, rules=BASE_RULES, rules_version: str = BASE_VERSION) -> DataFrame:
        """Scan what is new in ``versions`` (path, text), note it in the ledger and return ``versions`` with their spans.

        The result has a row per version: path, blob and ``spans`` (start, place of the rule, end, kind), in code points
        with the end exclusive. A NULL text is an empty one; a NULL path is kept; repeated versions are scanned once and
        returned as often as they are given; an empty table scans nothing; other columns are ignored. A blob's outcome is
        one row, so a scan that fails half-way leaves whole outcomes only, and the next scan takes up the rest. A change
        of the rules needs another ``rules_version``; what the older one found stays in the ledger.
        """
        versions = versions.select("path", F.coalesce("text", F.lit("")).alias("text"))
        blob = F.sha2("text", 256).alias("blob")
        known = self.read().where(F.col("rules") == rules_version).select("blob")
        unseen = versions.select("text", blob)
        if not known.isEmpty():
            # Digests are told apart before any text is moved. Where few blobs are new, texts of known ones stay where they are.
            new = materialise(versions.select(blob).distinct().join(known, "blob", "left_anti"))
            unseen = unseen.join(F.broadcast(new) if new.count() <= FEW_BLOBS else new, "blob", "left_semi")
        unseen = unseen.groupBy("text").agg(F.count("*").alias("copies")).select("text", blob)
        scan_blobs(unseen, rules).select("blob", F.lit(rules_version).alias("rules"), "spans").write.mode("append").parquet(self.path)
        found = self.read().where((F.col("rules") == rules_version) & (F.size("spans") > 0))
        found = found.groupBy("blob").agg(F.any_value("spans").alias("spans"))  # two scans at once may both note a blob
        return versions.select("path", blob).join(found, "blob", "left")


def spans_text(spans: Column) -> Column:
    """Spans as kind:start:end, joined by commas; empty where there are none."""
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.coalesce(F.array_join(F.transform(spans, one), ","), F.lit(""))
