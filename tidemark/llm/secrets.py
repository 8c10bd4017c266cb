"""Secrets by content: a ledger of scanned blobs, so each text is scanned once per rule version.

Only DataFrame functions are used, also for the positions of matches: a match is wrapped in two control characters, the
text is split at the first, and the lengths of the parts add up to code-point offsets.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import discard, written

# kind, pattern, group whose length counts, least length; in the order in which equal starts are listed
RULES = (
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    ("hex", r"[0-9a-f]{32,}", 0, 32),  # runs are maximal, so shorter ones need not be marked
)
VERSION = "1"
OPEN, CLOSE, OTHER = "\x01", "\x02", "\x03"
LEDGER = "sha string, version string, spans array<struct<start:long,rank:int,kind:string,end:long>>"


def blobs(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with ``__blob``, the SHA-256 of their text; null counts as empty."""
    return docs.withColumn("__text", F.coalesce(docs[text], F.lit(""))).withColumn("__blob", F.sha2(F.col("__text"), 256))


def detect(texts: DataFrame, rules=RULES) -> DataFrame:
    """Rows (sha, spans) of ``texts`` (sha, __text) that hold a match; spans are sorted by start, then rule order.

    Matches of one rule are the leftmost that do not overlap; offsets are code points, the end exclusive.
    """
    # the control characters are in no rule's pattern: replacing those of the text by another changes no match
    safe = F.translate("__text", OPEN + CLOSE, OTHER + OTHER)
    cut = [F.struct(F.lit(rank).alias("rank"), F.split(F.regexp_replace(safe, F.lit(pattern), F.lit(f"{OPEN}$0{CLOSE}")), OPEN).alias("parts"))
           for rank, (_, pattern, _, _) in enumerate(rules)]
    marked = texts.select("sha", F.explode(F.array(*cut)).alias("r")).select("sha", "r.rank", "r.parts").where(F.size("parts") > 1)

    def measured(part, at):
        hit = F.substring_index(part, CLOSE, 1)
        counted = F.length(hit)
        for rank, (_, pattern, group, _) in enumerate(rules):
            if group:
                counted = F.when(F.col("rank") == rank, F.length(F.regexp_extract(hit, pattern, group))).otherwise(counted)
        return F.struct(F.length(part).cast("long").alias("n"),
                        F.when(at > 0, F.length(hit).cast("long")).alias("hit"), F.when(at > 0, counted).alias("counted"))

    order = Window.partitionBy("sha", "rank").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    parts = marked.select("sha", "rank", F.posexplode(F.transform("parts", measured)).alias("i", "p")).select("sha", "rank", "i", "p.*")
    # a part after the first holds one closing character more than the text
    placed = parts.withColumn("start", F.sum(F.col("n") - F.when(F.col("i") > 0, 1).otherwise(0)).over(order))
    least = F.lit(0)
    kind = F.lit("")
    for rank, (name, _, _, most) in enumerate(rules):
        least = F.when(F.col("rank") == rank, most).otherwise(least)
        kind = F.when(F.col("rank") == rank, name).otherwise(kind)
    found = placed.where((F.col("i") > 0) & (F.col("counted") >= least))
    return found.groupBy("sha").agg(F.sort_array(F.collect_list(F.struct(
        "start", "rank", kind.alias("kind"), (F.col("start") + F.col("hit")).alias("end")))).alias("spans"))


def read_ledger(spark, path: str) -> DataFrame | None:
    """The ledger, or None where nothing has been written yet; anything else that fails is raised."""
    try:
        return spark.read.schema(LEDGER).parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def scan_new(found: DataFrame, ledger: str, rules=RULES, version: str = VERSION) -> DataFrame:
    """Scan the blobs of ``found`` that the ledger lacks for this rule version, append them, return the ledger's rows.

    One row per scanned blob, with or without spans, is appended by one write: after a failed run the blobs are still unseen.
    """
    spark = found.sparkSession
    known = read_ledger(spark, ledger)
    fresh = found.select(F.col("__blob").alias("sha"), "__text")
    if known is not None:
        fresh = fresh.join(known.where(F.col("version") == version).select("sha"), "sha", "left_anti")
    fresh = fresh.groupBy("sha").agg(F.first("__text").alias("__text"))
    fresh = written(fresh, "blobs")
    none = F.array().cast("array<struct<start:long,rank:int,kind:string,end:long>>")
    rows = fresh.select("sha").join(detect(fresh, rules), "sha", "left").select(
        "sha", F.lit(version).alias("version"), F.coalesce("spans", none).alias("spans"))
    rows.write.mode("append").parquet(ledger)
    discard(fresh)
    return read_ledger(spark, ledger).where(F.col("version") == version)


def scan(docs: DataFrame, ledger: str | None = None, text: str = "text", rules=RULES, version: str = VERSION) -> DataFrame:
    """``docs`` with ``spans``, the findings of each row's text; an empty array where there are none.

    Every row is a version of a path; equal texts share one scan and one ledger row. Null text counts as empty, repeated
    rows get equal findings, other columns are passed on. ``ledger`` is a folder; without one, a new one in the shared folder is used.
    """
    ledger = ledger or scratch_path(docs.sparkSession, "secrets")
    found = blobs(docs, text)
    rows = scan_new(found, ledger, rules, version)
    joined = found.join(rows.select(F.col("sha").alias("__blob"), F.col("spans").alias("__spans")), "__blob", "left")
    none = F.array().cast("array<struct<start:long,rank:int,kind:string,end:long>>")
    kept = [joined[c] for c in docs.columns if c != "spans"]
    return joined.select(*kept, F.coalesce("__spans", none).alias("spans"))


def listed(spans="spans"):
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(docs: DataFrame, ledger: str | None = None, text: str = "text", mark: str = "[secret]") -> DataFrame:
    """``docs`` with every found span of the text replaced by ``mark``; texts without findings and null texts stay as they are.

    Overlapping spans are replaced once. The columns are those of ``docs``.
    """
    spans = scan(docs.withColumn("__whole", docs[text]), ledger, text)
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))
    merged = F.aggregate(
        "spans", start,
        lambda acc, s: F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(s["start"] >= acc["at"], F.concat(acc["out"], F.array(
                F.col("__whole").substr((acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")), F.lit(mark))))
            .otherwise(acc["out"]).alias("out")),
        lambda acc: F.concat(F.array_join(acc["out"], ""), F.col("__whole").substr((acc["at"] + 1).cast("int"), F.length("__whole"))))
    return spans.select(*(F.when(F.size("spans") > 0, merged).otherwise(F.col(text)).alias(text) if c == text else spans[c]
                          for c in docs.columns))
