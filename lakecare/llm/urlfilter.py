"""URL filter: a blocked Bloom filter in front of an exact hash join, in DataFrame operations only.

Rules name a host and a path; they fit the host, its subdomains and all paths that start with
theirs. Listed URLs fit all spellings of themselves: both sides are brought to a canonical form first.
A URL is spread into the keys an entry could have that fits it; keys the filter surely does not hold
are gone at once, the others meet the entries in an exact join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakecare.session import stage

#: A block is eight 64-bit words with one bit set in each per entry; the filter's blocks are
#: bounded, so it is broadcast at 18 MB at most. More entries than that only let more keys
#: through to the exact join.
MOST_BLOCKS = 1 << 18
ENTRIES_PER_BLOCK = 32
WORDS = 8

AUTHORITY = r"^.*?://([^/?#]*)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    rest = F.substring_index(_after_scheme(url), "/", 1)
    bare = F.substring_index(F.substring_index(rest, "?", 1), "#", 1)
    return F.translate(bare, UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    rest = _after_scheme(url)
    whole = F.substring_index(F.substring_index(rest, "?", 1), "#", 1)
    return whole.substr(F.length(host_of(url)) + 1, F.length(whole))


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise(F.lit(""))


#: Characters whose escapes mean the character itself.
UNRESERVED = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-._~"


def canonical_host(host: Column) -> Column:
    """A host without user, default port and closing dots: ``u@a.example.:80`` -> ``a.example``."""
    bare = F.substring_index(host, "@", -1)
    return F.regexp_replace(F.regexp_replace(bare, r":(80|443)?$", ""), r"\.+$", "")


def canonical_path(path: Column) -> Column:
    """A path with dot segments resolved, needless escapes undone and the others in upper case; an empty one is ``/``."""
    meant = F.create_map(*[F.lit(x) for c in UNRESERVED for x in (f"{ord(c):02X}", c)])
    pieces = F.split(path, "%")

    def spelt(piece: Column) -> Column:
        code = F.upper(piece.substr(1, 2))
        return F.concat(F.coalesce(meant[code], F.concat(F.lit("%"), code)), piece.substr(F.lit(3), F.length(piece)))

    rest = F.transform(F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0))), spelt)
    readable = F.concat(F.get(pieces, F.lit(0)), F.array_join(rest, ""))
    parts = F.split(readable, "/")
    none = F.array().cast("array<string>")
    walked = F.aggregate(
        F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))),
        none,
        lambda done, part: F.when(part == ".", done)
        .when(part == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))))
        .otherwise(F.concat(done, F.array(part))),
    )
    folder = F.element_at(parts, -1).isin(".", "..")  # what a closing dot segment names ends in a slash
    resolved = F.concat(F.lit("/"), F.array_join(walked, "/"), F.when(folder & (F.size(walked) > 0), "/").otherwise(""))
    dotted = readable.rlike(r"/\.{1,2}(/|$)")
    return F.when(path == "", "/").when(dotted, resolved).otherwise(readable)


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def _bit(key: Column, word: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(word)), F.lit(64)).cast("int")


def bloom_filter(keys: DataFrame, blocks: int) -> DataFrame:
    """(block, w0..w7) of the blocks that hold any of ``keys(key)``; partial ORs combine before the shuffle."""
    one = F.lit(1).cast("long")
    words = [F.bit_or(F.call_function("shiftleft", one, _bit(F.col("key"), i))).alias(f"w{i}") for i in range(WORDS)]
    return keys.groupBy(_block(F.col("key"), blocks).alias("block")).agg(*words)


def flag_possible(rows: DataFrame, key: str, bloom: DataFrame, blocks: int, flag: str) -> DataFrame:
    """``rows`` with a boolean: whether the filter may hold ``key``; false only if it surely does not."""
    hit = reduce(
        lambda a, b: a & b,
        [F.call_function("getbit", F.col(f"w{i}"), _bit(F.col(key), i)) == 1 for i in range(WORDS)],
    )
    probed = rows.withColumn("block", _block(F.col(key), blocks))
    joined = probed.join(F.broadcast(bloom), "block", "left")
    return joined.withColumn(flag, F.coalesce(hit, F.lit(False))).select(*rows.columns, flag)


def possible(keys: DataFrame, bloom: DataFrame, blocks: int) -> DataFrame:
    """Rows of ``keys(key, ...)`` that the filter may hold; none that it holds is lost."""
    return flag_possible(keys, "key", bloom, blocks, "_may").where("_may").drop("_may")


def suffixes(host: Column, counts: Column) -> Column:
    """The last labels of the host, for each of the given counts that it has."""
    labels = F.split(host, r"\.")
    return F.transform(
        F.filter(counts, lambda n: n <= F.size(labels)),
        lambda n: F.array_join(F.slice(labels, F.size(labels) - n + 1, n), "."),
    )


def url_filter(pages: DataFrame, rules: DataFrame, listed: DataFrame, url: str = "url") -> DataFrame:
    """``pages`` with host, path, rule and verdict of every row's URL.

    ``rules(host, path, action)`` fit hosts with their subdomains and paths by prefix; of those
    that fit, the longest decides (of equal ones, the last in text order). A URL without a
    fitting rule is blocked if ``listed(host, path)`` holds it in any spelling, and allowed otherwise. Null
    URLs, and those without ``://``, have an empty host and path and fit no rule with a host.
    Repeated rows, rules and listed URLs change nothing; very long hosts and paths are compared at the lengths
    that rules have. An empty table gives no rows. Columns named like the results give way to them.
    """
    entries = stage(
        rules.select(
            F.concat_ws(" ", F.lit("rule"), F.concat("host", "path")).alias("key"),
            F.concat("host", "path").alias("rule"),
            "action",
            F.length("path").alias("path_length"),
            F.size(F.split("host", r"\.")).alias("labels"),
        )
        .unionByName(
            listed.select(
                F.concat_ws(" ", F.lit("page"), F.concat(canonical_host(F.col("host")), canonical_path(F.col("path")))).alias("key"),
                F.lit(None).cast("string").alias("rule"),
                F.lit("block").alias("action"),
                F.lit(None).cast("int").alias("path_length"),
                F.lit(None).cast("int").alias("labels"),
            )
        )
        .where("key IS NOT NULL")
        .distinct(),
        "url-entries",
    )
    counted = entries.agg(F.count(F.lit(1)), F.collect_set("path_length"), F.collect_set("labels")).first()
    blocks = max(1, min(MOST_BLOCKS, -(-counted[0] // ENTRIES_PER_BLOCK)))
    bloom = bloom_filter(entries.select("key"), blocks)
    lengths, labels = (F.array(*[F.lit(n) for n in sorted(found)]).cast("array<int>") for found in counted[1:])

    kept = pages.drop("host", "path", "rule", "verdict")
    named = kept.select(F.struct(*kept.columns).alias("page"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    distinct = named.select("host", "path").distinct()
    prefixes = F.transform(
        F.filter(lengths, lambda n: n <= F.length("path")), lambda n: F.col("path").substr(F.lit(1), n)
    )
    of_rules = F.flatten(
        F.transform(
            suffixes(F.col("host"), labels),
            lambda h: F.transform(prefixes, lambda p: F.concat(F.lit("rule "), h, p)),
        )
    )
    spelt = F.concat(canonical_host(F.col("host")), canonical_path(F.col("path")))
    own = F.array(F.concat(F.lit("page "), spelt))
    keys = distinct.select("host", "path", F.explode(F.concat(of_rules, own)).alias("key"))
    hits = possible(keys, bloom, blocks).join(entries, "key")
    best = hits.groupBy("host", "path").agg(
        F.max(F.struct(F.coalesce(F.length("rule"), F.lit(-1)).alias("n"), "rule", "action")).alias("best")
    )
    found = best.select(
        F.col("host").alias("_host"), F.col("path").alias("_path"), F.col("best.rule").alias("rule"), "best.action"
    )
    joined = named.join(found, (F.col("host") == F.col("_host")) & (F.col("path") == F.col("_path")), "left")
    return joined.select("page.*", "host", "path", "rule", F.coalesce("action", F.lit("allow")).alias("verdict"))
