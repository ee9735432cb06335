"""Secret scan over an incremental ledger of content-addressed texts, in DataFrame operations only.

Every version of every path is addressed by the SHA-256 of its text. The ledger holds three
tables: ``paths``, every path with each blob it ever held and the scan that first saw it there;
``scanned``, the pairs of blob and rule version already looked at; ``findings``, their hits. A scan
runs only the rules a blob has not met yet, on one row of each such blob, and the findings are
joined back to the paths that hold the blob now, or to all that ever held it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakecare.llm.common import whole_text
from lakecare.llm.urlfilter import ENTRIES_PER_BLOCK, MOST_BLOCKS, bloom_filter, flag_possible
from lakecare.session import scratch_path, stage
from lakecare.sinks.tables import path_exists

PLACEHOLDER = "[secret]"


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of ``pattern`` whose ``group`` has ``least`` characters or more."""

    name: str
    version: int
    pattern: str
    group: int
    least: int


#: The kinds of secret, their patterns and least lengths, in the order in which they are listed.
#: A run of 24 or more hex digits is what is left of all runs once the short ones are dropped.
RULES = (
    Rule(
        "assign",
        1,
        r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
        r"|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        2,
        6,
    ),
    Rule("access", 1, r"(AKIA[A-Z0-9]+)", 1, 20),
    Rule("hex", 1, r"([0-9a-f]{24,})", 1, 24),
)

SCANNED = "blob string, rule string, version int"
FINDINGS = "blob string, rule string, version int, start int, end int"
PATHS = "path string, blob string, scan int"


def blob_of(text: Column) -> Column:
    return F.sha2(text, 256)


def _ledger(spark: SparkSession, path: str, name: str, schema: str) -> DataFrame:
    folder = f"{path}/{name}"
    return spark.read.schema(schema).parquet(folder) if path_exists(spark, folder) else spark.createDataFrame([], schema)


def _measured(rule: Rule) -> Callable[[Column, Column], Column]:
    return lambda m, i: F.struct(
        F.lit(rule.name).alias("rule"),
        F.lit(rule.version).alias("version"),
        F.lit(rule.least).alias("least"),
        i.alias("i"),
        F.length(m["before"]).alias("gap"),
        F.length(m["match"]).alias("size"),
        F.length(m["value"]).alias("value"),
    )


def _hits(rows: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(blob, rule, version, i, gap, size, value): each match with the code points since the one before.

    The pieces between matches, and the matches, alternate through the text, so offsets
    follow from their lengths.
    """
    found = []
    for rule in rules:
        pattern = F.lit(rule.pattern)
        wanted = F.array_contains("rules", F.lit(f"{rule.name}/{rule.version}")) & F.col("text").rlike(rule.pattern)
        matches = F.arrays_zip(
            F.split("text", rule.pattern, -1).alias("before"),
            F.regexp_extract_all("text", pattern, F.lit(0)).alias("match"),
            F.regexp_extract_all("text", pattern, F.lit(rule.group)).alias("value"),
        )
        found.append(F.when(wanted, F.transform(matches, _measured(rule))))
    everything = F.concat(*[F.coalesce(f, F.array()) for f in found])
    return rows.select("blob", F.explode(everything).alias("hit")).select("blob", "hit.*").where("size IS NOT NULL")


def scan(
    documents: DataFrame, ledger: str, rules: Sequence[Rule] = RULES, path: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Bring ``ledger`` up to date with ``documents`` and return the staged (path, blob) of every row.

    A stopped run is mended by repeating it: findings are written before the pairs they come
    from count as scanned, and readers take each finding once. Null and empty texts share one
    blob. Repeated rows are scanned as often as the one chosen row of a blob is repeated, with
    the same findings. The ledger keeps paths as text. An empty table changes nothing; very long
    texts are scanned whole; other columns are not read.
    """
    spark = documents.sparkSession
    texts = documents.select(F.col(path).alias("path"), whole_text(text).alias("text")).withColumn(
        "blob", blob_of(F.col("text"))
    )
    versions = stage(texts.select("path", "blob"), "secret-versions")
    _remember(versions, ledger)
    known = F.array(*[F.lit(f"{r.name}/{r.version}") for r in rules])
    seen = (
        _ledger(spark, ledger, "scanned", SCANNED)
        .groupBy("blob")
        .agg(F.collect_set(F.concat_ws("/", "rule", F.col("version").cast("string"))).alias("seen"))
    )
    chosen = versions.groupBy("blob").agg(F.min("path").alias("path"))
    unseen = (
        chosen.join(seen, "blob", "left")
        .withColumn("rules", F.array_except(known, F.coalesce("seen", F.array().cast("array<string>"))))
        .where(F.size("rules") > 0)
        .select("blob", "path", "rules")
    )
    todo = stage(unseen, "secret-unseen")
    rows = texts.alias("t").join(
        todo.alias("u"), (F.col("t.blob") == F.col("u.blob")) & F.col("t.path").eqNullSafe(F.col("u.path"))
    )
    hits = _hits(rows.select("t.blob", "t.text", "u.rules"), rules).repartition("blob", "rule")
    before = Window.partitionBy("blob", "rule").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    findings = (
        hits.dropDuplicates(["blob", "rule", "i"])
        .withColumn("end", F.sum(F.col("gap") + F.col("size")).over(before).cast("int"))
        .where("value >= least")
        .select("blob", "rule", "version", (F.col("end") - F.col("size")).alias("start"), "end")
    )
    findings.write.mode("append").parquet(f"{ledger}/findings")
    (
        todo.select("blob", F.explode("rules").alias("pair"))
        .select(
            "blob",
            F.substring_index("pair", "/", 1).alias("rule"),
            F.substring_index("pair", "/", -1).cast("int").alias("version"),
        )
        .write.mode("append")
        .parquet(f"{ledger}/scanned")
    )
    return versions


def _remember(versions: DataFrame, ledger: str) -> None:
    """Add the pairs of path and blob that no scan has seen to the ledger, under this scan's number."""
    known = _ledger(versions.sparkSession, ledger, "paths", PATHS)
    scan_number = (known.agg(F.max("scan")).first()[0] or 0) + 1
    held = versions.select(F.col("path").cast("string").alias("path"), "blob").distinct()
    if scan_number > 1:
        n, k = held.alias("n"), known.alias("k")
        same = (F.col("n.blob") == F.col("k.blob")) & F.col("n.path").eqNullSafe(F.col("k.path"))
        held = n.join(k, same, "left_anti")
    held.withColumn("scan", F.lit(scan_number)).write.mode("append").parquet(f"{ledger}/paths")


def exposures(spark: SparkSession, ledger: str, rules: Sequence[Rule] = RULES) -> DataFrame:
    """(path, blob, scan, rule, start, end): every finding at every path that ever held its blob.

    A path that no longer holds the secret is still there, as is one that is gone: the text was
    published once. ``scan`` is the scan that first saw the blob at the path.
    """
    versions = F.create_map(*[x for r in rules for x in (F.lit(r.name), F.lit(r.version))])
    found = _ledger(spark, ledger, "findings", FINDINGS).where(F.col("version") == versions[F.col("rule")])
    return _ledger(spark, ledger, "paths", PATHS).join(found.drop("version").distinct(), "blob").select(
        "path", "blob", "scan", "rule", "start", "end"
    )


def spans_by_blob(spark: SparkSession, ledger: str, rules: Sequence[Rule] = RULES) -> DataFrame:
    """(blob, spans) for blobs with findings of these rule versions; spans ordered by start, then kind as listed."""
    order = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(f"{r.name}/{r.version}"), F.lit(i))])
    return (
        _ledger(spark, ledger, "findings", FINDINGS)
        .withColumn("kind", order[F.concat_ws("/", "rule", F.col("version").cast("string"))])
        .where("kind IS NOT NULL")
        .groupBy("blob")
        .agg(F.array_sort(F.collect_set(F.struct("start", "kind", "end", "rule"))).alias("spans"))
    )


def secret_report(documents: DataFrame, ledger: str | None = None, rules: Sequence[Rule] = RULES) -> DataFrame:
    """One row per row of ``documents(doc_id, text)``: doc_id, blob and its spans (empty if none)."""
    spark = documents.sparkSession
    ledger = ledger or scratch_path(spark, "secret-ledger")
    versions = scan(documents, ledger, rules)
    found = spans_by_blob(spark, ledger, rules)
    none = F.array().cast("array<struct<start:int,kind:int,end:int,rule:string>>")
    return versions.join(found, "blob", "left").select(
        F.col("path").alias("doc_id"), "blob", F.coalesce("spans", none).alias("spans")
    )


def digest(report: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Counts per kind, the spans as ``kind:start:end`` text and its SHA-256."""
    listed = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["rule"], s["start"], s["end"])), ",")

    def count(name: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["rule"] == name)).cast("long").alias(f"n_{name}")

    counts = [count(r.name) for r in rules]
    return report.select("doc_id", *counts, F.sha2(listed, 256).alias("base_sha256"), listed.alias("spans"))


def redact(documents: DataFrame, ledger: str, rules: Sequence[Rule] = RULES) -> DataFrame:
    """``documents`` with each span, or run of overlapping spans, replaced by a placeholder.

    ``n_chars`` follows the new text. Rows without findings stay as they are, null texts too.
    Repeated rows stay repeated; all columns are kept, whatever their names; an empty table stays empty.
    """
    spark = documents.sparkSession
    scan(documents.select("doc_id", "text"), ledger, rules)
    found = stage(spans_by_blob(spark, ledger, rules), "secret-spans")
    text = F.col("doc.text")

    def step(done: Column, span: Column) -> Column:
        fresh = span["start"] >= done["at"]
        kept = text.substr(done["at"] + 1, F.greatest(span["start"] - done["at"], F.lit(0)))
        out = F.when(fresh, F.concat(done["out"], kept, F.lit(PLACEHOLDER))).otherwise(done["out"])
        return F.struct(F.greatest(done["at"], span["end"]).alias("at"), out.alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    stitched = F.aggregate("spans", start, step, lambda d: F.concat(d["out"], text.substr(d["at"] + 1, F.length(text))))
    # a bounded filter of the blobs with findings spares all other texts the join
    blocks = max(1, min(MOST_BLOCKS, -(-found.count() // ENTRIES_PER_BLOCK)))
    bloom = bloom_filter(found.select(F.col("blob").alias("key")), blocks)
    packed = documents.select(F.struct("*").alias("doc"), blob_of(whole_text()).alias("blob"))
    marked = flag_possible(packed, "blob", bloom, blocks, "possible")
    joined = marked.where("possible").join(found, "blob", "left").withColumn("stitched", F.when(F.col("spans").isNotNull(), stitched))
    length = F.when(F.col("spans").isNull(), F.col("doc.n_chars")).otherwise(F.length("stitched").cast("long"))
    renewed = F.col("doc").withField("text", F.when(F.col("spans").isNull(), text).otherwise(F.col("stitched")))
    changed = joined.select(renewed.withField("n_chars", length).alias("doc"))
    return marked.where("NOT possible").select("doc").unionByName(changed).select("doc.*")
