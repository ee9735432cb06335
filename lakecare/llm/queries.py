"""The registered corpus queries: thin digests of the operators over whole tables, and their SQL counterparts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakecare.llm import (
    ann,
    fingerprints,
    html_extract,
    langid,
    merkle,
    mixing,
    negatives,
    packing,
    pii,
    secret_scan,
    simhash,
    toxicity,
    urlfilter,
)
from lakecare.llm.common import remainder, table

LANGUAGE_FOLDS, LANGUAGE_HELD = 4, 2
TOXIC_FOLDS, TOXIC_HELD = 5, 0
TAMPERED = 5

#: The URL rules as (host, path, action).
URL_RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
#: Site names whose pages the list of canonical URLs is made of.
UNWANTED_SITES = ("ads-track", "casino-win", "cheap-pills", "free-bets")


def op1_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.digest(secret_scan.secret_report(table(spark, folder, "documents")))


def op2_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held = remainder("doc_id", LANGUAGE_FOLDS) == LANGUAGE_HELD
    model = langid.train(docs.where(~held).select("doc_id", "text", "lang"))
    return langid.identify(docs.select("doc_id", held.alias("held_out"), "text"), model)


def op3_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return html_extract.extract(table(spark, folder, "pages"))


def op4_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    held = remainder("doc_id", TOXIC_FOLDS) == TOXIC_HELD
    labels = table(spark, folder, "labels").select("doc_id", "toxic")
    model = toxicity.train(docs.where(~held), labels.where(~held))
    return toxicity.score(docs.select("doc_id", held.alias("held_out"), "text"), model)


def op6_nearest(spark: SparkSession, folder: str) -> DataFrame:
    return ann.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)


def listed_urls(pages: DataFrame) -> DataFrame:
    """Canonical URLs of the pages of unwanted sites."""
    named = pages.select(urlfilter.host_of(F.col("url")).alias("host"), urlfilter.path_of(F.col("url")).alias("path"))
    return named.where(F.arrays_overlap(F.split("host", r"\."), F.array(*map(F.lit, UNWANTED_SITES))))


def op7_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url")
    rules = spark.createDataFrame(list(URL_RULES), "host string, path string, action string")
    judged = urlfilter.url_filter(pages, rules, listed_urls(pages))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"))


def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op10_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.document_fingerprints(table(spark, folder, "documents"))


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    relabelled = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, folder, "embeddings").select("vec_id", relabelled.alias("label"), F.col("embedding").alias("vector"))
    return negatives.hard_negatives(vectors, F.col("vec_id") % 100 == 0)


def op12_merkle(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPERED == 0
    text = F.when(tampered, merkle.lower_ascii(F.col("text"))).otherwise(F.col("text"))
    return merkle.checked(merkle.proofs(docs, changed=text))


def op13_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.digest(pii.private_spans(table(spark, folder, "documents")))


QUERIES = {
    q.__name__: q
    for q in (
        op1_secret_scan,
        op2_language_id,
        op3_html_extraction,
        op4_simhash,
        op5_toxicity,
        op6_nearest,
        op7_url_filter,
        op8_packing,
        op9_mixing,
        op10_fingerprints,
        op11_hard_negatives,
        op12_merkle,
        op13_pii,
    )
}


def _secret_sql() -> str:
    parts = []
    for place, rule in enumerate(secret_scan.RULES):
        pattern = rule.pattern.replace("'", "''")
        parts.append(f"""
  SELECT doc_id, '{rule.name}' AS kind, {place} AS place, {rule.least} AS least,
    unnest(string_split_regex(body, '{pattern}')[1:len(regexp_extract_all(body, '{pattern}'))]) AS gap,
    unnest(regexp_extract_all(body, '{pattern}')) AS hit,
    unnest(regexp_extract_all(body, '{pattern}', {rule.group})) AS val,
    generate_subscripts(regexp_extract_all(body, '{pattern}'), 1) AS i
  FROM texts WHERE regexp_matches(body, '{pattern}')""")
    counts = ",\n  ".join(
        f"count(*) FILTER (WHERE kind = '{r.name}') AS n_{r.name}" for r in secret_scan.RULES
    )
    return f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
hits AS ({" UNION ALL ".join(parts)}),
placed AS (
  SELECT *, sum(length(gap) + length(hit)) OVER (PARTITION BY doc_id, kind ORDER BY i) AS finish FROM hits),
spans AS (
  SELECT doc_id, kind, place, (finish - length(hit))::BIGINT AS start, finish::BIGINT AS finish
  FROM placed WHERE length(val) >= least),
listed AS (
  SELECT doc_id, {counts},
    coalesce(string_agg(kind || ':' || start || ':' || finish, ',' ORDER BY start, place), '') AS spans
  FROM spans GROUP BY doc_id)
SELECT doc_id, {", ".join(f"coalesce(n_{r.name}, 0) AS n_{r.name}" for r in secret_scan.RULES)},
  sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents LEFT JOIN listed USING (doc_id)"""


def _mixing_sql() -> str:
    weights = " ".join(f"WHEN {i} THEN {w}" for i, w in enumerate(mixing.WEIGHTS))
    return f"""
WITH sizes AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{mixing.WORD}'))::BIGINT AS size, md5(coalesce(text, '')) AS digest,
    row_number() OVER (PARTITION BY doc_id, source, md5(coalesce(text, ''))) AS place FROM documents),
each AS (SELECT source, sum(size)::BIGINT AS source_size FROM sizes GROUP BY source),
weighed AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mixing.WEIGHTS)} {weights} END::DOUBLE AS weight,
    source_size * {mixing.MOST}::DOUBLE AS lim FROM each),
levels AS (
  SELECT *, (sum(source_size) OVER ()::DOUBLE - coalesce(sum(lim) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed WINDOW o AS (ORDER BY lim / weight, source NULLS LAST)),
targets AS (
  SELECT source, source_size, coalesce(least(lim, weight * max(CASE WHEN lim / weight >= level THEN level END) OVER ()), lim) AS target
  FROM levels),
rates AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM targets),
drawn AS (
  SELECT doc_id, size, source_size, target, rate,
    ('0x' || md5('{mixing.SEED}:' || coalesce(doc_id::VARCHAR, '') || ':' || digest || ':' || place)[1:13])::BIGINT::DOUBLE / {float(2**52)} AS draw
  FROM sizes JOIN rates ON sizes.source IS NOT DISTINCT FROM rates.source)
SELECT doc_id, size, source_size, target,
  (size * (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken FROM drawn"""


def _url_sql() -> str:
    rules = ", ".join(f"('{h}', '{p}', '{a}')" for h, p, a in URL_RULES)
    sites = ", ".join(f"'{s}'" for s in UNWANTED_SITES)
    return f"""
WITH rules(rule_host, rule_path, action) AS (VALUES {rules}),
rest AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS after FROM pages),
named AS (
  SELECT page_id, translate(raw, '{urlfilter.UPPER}', '{urlfilter.LOWER}') AS host,
    regexp_extract(substr(after, length(raw) + 1), '^[^?#]*') AS path
  FROM (SELECT *, regexp_extract(after, '^[^/?#]*') AS raw FROM rest)),
fit AS (
  SELECT page_id, max(struct_pack(n := length(rule_host || rule_path), rule := rule_host || rule_path, action := action)) AS best
  FROM named JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY page_id)
SELECT page_id, host, path, best.rule AS rule,
  coalesce(best.action, CASE WHEN list_has_any(string_split(host, '.'), [{sites}]) THEN 'block' ELSE 'allow' END) AS verdict
FROM named LEFT JOIN fit USING (page_id)"""


def _negatives_sql() -> str:
    return f"""
WITH taking AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor({negatives.SCALE} * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, a.label = r.label AS same, r.vec_id, list_inner_product(a.v, r.v)::BIGINT AS score
  FROM taking a JOIN taking r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS positive_rank
  FROM scored WHERE same QUALIFY positive_rank <= {negatives.POSITIVES})
SELECT p.anchor_id, p.vec_id AS positive_id, p.score AS positive_score, p.positive_rank::INT AS positive_rank,
  n.vec_id AS negative_id, n.score AS negative_score,
  (row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id))::INT AS rank
FROM positives p JOIN scored n ON p.anchor_id = n.anchor_id AND NOT n.same
  AND 100 * n.score BETWEEN {negatives.LEAST_SHARE} * p.score AND {negatives.MOST_SHARE} * p.score
QUALIFY rank <= {negatives.NEGATIVES}"""


def _merkle_sql(group_levels: int = 6, crown_levels: int = 4) -> str:
    """Levels are written out: up to 16**6 documents a source and 16**4 sources."""
    fields = ", ".join(f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')" for c in merkle.COLUMNS)
    lowered = fields.replace("text::VARCHAR", f"translate(text, '{merkle.UPPER}', '{merkle.LOWER}')")
    polynomial = 0xEDB88320

    def levels(prefix: str, count: int) -> str:
        steps = []
        for m in range(count):
            steps.append(f"""
{prefix}{m + 1} AS (
  SELECT tree, place // 16 AS place, CASE WHEN any_value(n) > 1 THEN sha256(string_agg(digest, '' ORDER BY place)) ELSE any_value(digest) END AS digest,
    (any_value(n) + 15) // 16 AS n FROM {prefix}{m} GROUP BY tree, place // 16)""")
        return ",".join(steps)

    def paths(prefix: str, count: int, source: str) -> str:
        """Left and right siblings of every leaf of ``source`` at every level, null where the level has one node."""
        columns = []
        for m in range(count):
            for side, sign in (("l", "<"), ("r", ">")):
                columns.append(
                    f"(SELECT coalesce(string_agg(x.digest, '' ORDER BY x.place), '') FROM {prefix}{m} x WHERE x.tree = s.tree"
                    f" AND x.place // 16 = s.place // {16 ** (m + 1)} AND x.place {sign} s.place // {16**m}) AS {side}{m}"
                )
            columns.append(f"(SELECT any_value(x.n) > 1 FROM {prefix}{m} x WHERE x.tree = s.tree) AS up{m}")
        return f"SELECT s.*, {', '.join(columns)} FROM {source} s"

    def siblings(alias: str, count: int) -> str:
        return " || ".join(f"CASE WHEN {alias}.up{m} THEN {alias}.l{m} || {alias}.r{m} ELSE '' END" for m in range(count))

    def folding(alias: str, before: str, count: int, name: str) -> str:
        """One query for each level, as nested expressions would repeat the digest below them."""
        text, last = [], before
        for m in range(count):
            text.append(
                f"{name}{m} AS (SELECT * EXCLUDE (acc), CASE WHEN {alias}up{m} THEN sha256({alias}l{m} || acc || {alias}r{m}) ELSE acc END AS acc FROM {last})"
            )
            last = f"{name}{m}"
        return ",\n".join(text)

    return f"""
WITH crcs AS (
  SELECT doc_id, xor(list_reduce(list_prepend(4294967295::UBIGINT, flatten(list_transform(
      string_split(doc_id::VARCHAR, ''), lambda c: [ascii(c)::UBIGINT, 0, 0, 0, 0, 0, 0, 0]))),
    lambda acc, x: CASE WHEN xor(acc, x) % 2 = 1 THEN xor(xor(acc, x) // 2, {polynomial}::UBIGINT) ELSE xor(acc, x) // 2 END), 4294967295::UBIGINT) AS crc
  FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL)),
leaves AS (
  SELECT doc_id, source, sha256(concat({fields})) AS digest,
    CASE WHEN crc % {TAMPERED} = 0 AND text IS NOT NULL THEN sha256(concat({lowered})) ELSE sha256(concat({fields})) END AS changed
  FROM documents LEFT JOIN crcs USING (doc_id)),
g0 AS (
  SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, digest) - 1 AS place,
    count(*) OVER (PARTITION BY source) AS n FROM leaves),{levels("g", group_levels)},
c0 AS (SELECT 0 AS tree, tree AS place, digest, count(*) OVER () AS n FROM g{group_levels}),{levels("c", crown_levels)},
below AS ({paths("g", group_levels, "g0")}),
beyond AS ({paths("c", crown_levels, "c0")}),
proved AS (
  SELECT b.*, b.changed AS acc, t.digest AS subroot, (SELECT digest FROM c{crown_levels}) AS root,
    sha256({siblings("b", group_levels)} || {siblings("t", crown_levels)}) AS proof_sha256,
    {", ".join(f"t.l{m} AS tl{m}, t.r{m} AS tr{m}, t.up{m} AS tup{m}" for m in range(crown_levels))}
  FROM below b JOIN beyond t ON b.tree = t.place),
{folding("", "proved", group_levels, "fg")},
{folding("t", f"fg{group_levels - 1}", crown_levels, "fc")}
SELECT doc_id, digest AS leaf, subroot, root, proof_sha256, acc AS folded_root, acc = root AS verified FROM fc{crown_levels - 1}"""


ORACLE = {
    "op1_secret_scan": _secret_sql(),
    "op7_url_filter": _url_sql(),
    "op9_mixing": _mixing_sql(),
    "op11_hard_negatives": _negatives_sql(),
    "op12_merkle": _merkle_sql(),
}
