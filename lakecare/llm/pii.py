"""Personal data and the words that give it away: information-theoretic sanitisation.

Protected entities are the values that the base patterns find. How strongly a term reveals an
entity is measured over the whole corpus: with ``N`` texts, the pointwise mutual information
``log2(N * together / (spread * known))`` of the texts in which the term stands near the entity
(``together``), those that hold the term (``spread``) and those that hold the entity (``known``)
never exceeds the entity's information ``log2(N / known)``, and reaches it for a term that occurs
nowhere else. A term that leaves at most ``REMOVE_BITS`` of that information open is removed, one
that leaves at most ``GENERALISE_BITS`` is generalised to its sort of word. A term must do so in
``SUPPORT`` different texts, as anything that occurs once occurs nowhere else.

Texts with entities, a few, are tokenised around them. All other texts meet the candidate terms in
a bounded Bloom filter and then an exact join, so no list of words or texts is ever broadcast.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakecare.llm.common import ship, whole_text
from lakecare.llm.merkle import LOWER, UPPER, lower_ascii
from lakecare.llm.urlfilter import ENTRIES_PER_BLOCK, MOST_BLOCKS, bloom_filter, flag_possible
from lakecare.session import stage

#: The kinds of personal data in the order in which they are listed.
KINDS = ("email", "ip", "card", "phone")
TERM = "term"
#: Words on either side of an entity that are near it, and different texts that must agree.
WINDOW, SUPPORT = 8, 3
#: Bits of an entity's information that a term may leave open to be removed, or generalised.
REMOVE_BITS, GENERALISE_BITS = 0.25, 0.5

#: What follows the first character of a match's fixed part; possessive, so that no run is read twice.
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
NO_DIGITS = re.compile(r"[^0-9]+")
WORD = re.compile(r"[^\W_]+")
#: The same words for Spark: what separates them.
BETWEEN_WORDS = r"[^\p{L}\p{N}]+"
LOWERED = str.maketrans(UPPER, LOWER)


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of a local part, ``@`` and a domain with a dot, found from their ``@``: linear in the text."""
    last = 0
    for found in DOMAIN.finditer(text):
        at = start = found.start()
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        if start < at:
            last = found.end()
            yield start, last


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def byte_sized(part: str) -> bool:
    short = part.lstrip("0")
    return len(short) <= 3 and int(short or 0) <= 255


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(kind, start, end, entity) of all personal data in the text, by kind, then start."""
    found: list[tuple[int, int, int, str]] = []
    if "@" in text:
        found += [(0, a, b, text[a:b].translate(LOWERED)) for a, b in emails(text)]
    if not DIGIT.search(text):
        return found
    for m in IP.finditer(text):
        if all(map(byte_sized, m[0].split("."))):
            found.append((1, m.start(), m.end(), m[0]))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = NO_DIGITS.sub("", m[0])
            if 16 <= len(digits) <= 19 and luhn(digits):
                found.append((2, m.start(), m.end(), digits))
    if "+" in text:
        for m in PHONE.finditer(text):
            digits = NO_DIGITS.sub("", m[0])
            if 8 <= len(digits) <= 15:
                found.append((3, m.start(), m.end(), digits))
    return found


def words_of(text: str, spans: list[tuple[int, int]]) -> list[tuple[int, int, str]]:
    """(start, end, term) of the words that lie in none of the spans."""
    merged: list[list[int]] = []
    for a, b in sorted(spans):
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    ends, starts = [b for _, b in merged], [a for a, _ in merged]
    out = []
    for m in WORD.finditer(text):
        i = bisect_right(ends, m.start())  # the first span that ends after the word begins
        if i == len(starts) or starts[i] >= m.end():
            out.append((m.start(), m.end(), m[0].translate(LOWERED)))
    return out


def contexts(text: str, spans: list[tuple[int, int, int, str]], window: int) -> dict[str, set[str]]:
    """The terms near each entity of a text; entities are named by a hash of kind and value."""
    words = words_of(text, [(a, b) for _, a, b, _ in spans])
    starts = [w[0] for w in words]
    near: dict[str, set[str]] = {}
    for kind, a, b, value in spans:
        name = xxhash.xxh3_128_hexdigest(f"{KINDS[kind]}:{value}")
        left, right = bisect_left(starts, a), bisect_left(starts, b)
        near.setdefault(name, set()).update(w[2] for w in words[max(left - window, 0) : right + window])
    return near


SPAN = "struct<kind:int,start:int,end:int>"
FOUND = f"doc_id long, blob string, base array<{SPAN}>, near array<struct<entity:string,terms:array<string>>>"


def find_base(documents: DataFrame, window: int) -> DataFrame:
    """(doc_id, blob, base, near) of every row: its spans and the terms near each of its entities."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])
        around = pa.struct([("entity", pa.string()), ("terms", pa.list_(pa.string()))])
        for batch in batches:
            base, near = [], []
            for value in batch.column(2):
                text = value.as_py()
                spans = base_spans(text)
                base.append([{"kind": k, "start": a, "end": b} for k, a, b, _ in spans])
                found = contexts(text, spans, window) if spans else {}
                near.append([{"entity": e, "terms": sorted(t)} for e, t in sorted(found.items())])
            columns = [batch.column(0), batch.column(1), pa.array(base, pa.list_(span)), pa.array(near, pa.list_(around))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "blob", "base", "near"])

    return documents.select("doc_id", "blob", "text").mapInArrow(run, FOUND)


def _bloom(keys: DataFrame, entries: int) -> tuple[DataFrame, int]:
    blocks = max(1, min(MOST_BLOCKS, -(-entries // ENTRIES_PER_BLOCK)))
    return bloom_filter(keys, blocks), blocks


def term_rows(documents: DataFrame, terms: DataFrame, entries: int) -> DataFrame:
    """(blob, term, ...) for each row of ``documents(blob, text)`` and each of ``terms(term, ...)`` that its text holds."""
    bloom, blocks = _bloom(terms.select(F.col("term").alias("key")), entries)
    words = F.array_distinct(F.split(lower_ascii(F.col("text")), BETWEEN_WORDS))
    spread = documents.select("blob", F.explode(words).alias("term"))
    return flag_possible(spread, "term", bloom, blocks, "_may").where("_may").drop("_may").join(terms, "term")


def disclosing_terms(
    documents: DataFrame,
    found: DataFrame,
    support: int = SUPPORT,
    remove_bits: float = REMOVE_BITS,
    generalise_bits: float = GENERALISE_BITS,
) -> DataFrame:
    """(term, entity, together, spread, known, information, pmi, action) of all terms beyond the thresholds.

    ``documents(blob, text)`` and their ``find_base``. Rows with equal texts count as often as they
    come, but give support once. Of a term's entities, each that it reveals has a row.
    """
    total = found.count()
    texts = found.where(F.size("near") > 0).groupBy("blob").agg(F.count(F.lit(1)).alias("rows"), F.first("near").alias("near"))
    pairs = texts.select("rows", F.explode("near").alias("n")).select("rows", "n.entity", "n.terms")
    known = pairs.groupBy("entity").agg(F.sum("rows").alias("known"))
    candidates = (
        pairs.select("rows", "entity", F.explode("terms").alias("term"))
        .groupBy("entity", "term")
        .agg(F.sum("rows").alias("together"), F.count(F.lit(1)).alias("texts"))
        .where(F.col("texts") >= support)
    )
    candidates = stage(candidates.join(known, "entity"), "pii-candidates")
    names = candidates.select("term").distinct()
    spread = term_rows(documents, names, names.count()).groupBy("term").agg(F.count(F.lit(1)).alias("spread"))
    measured = candidates.join(spread, "term").withColumns(
        {
            "information": F.log2(F.lit(float(total)) / F.col("known")),
            "pmi": F.log2(F.lit(float(total)) * F.col("together") / (F.col("spread") * F.col("known"))),
        }
    )
    # what stays open is the information less the mutual information; in this form it is free of rounding at 0
    left = F.log2(F.col("spread") / F.col("together"))
    action = F.when(left <= remove_bits, F.lit("remove")).when(left <= generalise_bits, F.lit("generalise"))
    return measured.withColumn("action", action).where("action IS NOT NULL").select(
        "term", "entity", "together", "spread", "known", "information", "pmi", "action"
    )


def locate(documents: DataFrame, terms: DataFrame) -> DataFrame:
    """(blob, added) of each text that holds some of ``terms(term, action)``: their places outside base spans."""
    spans = "array<struct<start:int,end:int,action:string>>"
    held = stage(
        term_rows(documents, terms, terms.count()).groupBy("blob").agg(F.collect_set(F.struct("term", "action")).alias("terms")),
        "pii-held",
    )
    bloom, blocks = _bloom(held.select(F.col("blob").alias("key")), held.count())
    possible = flag_possible(documents.select("blob", "text"), "blob", bloom, blocks, "_may").where("_may")
    texts = possible.groupBy("blob").agg(F.first("text").alias("text")).join(held, "blob")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("action", pa.string())])
        for batch in batches:
            out = []
            for text, wanted in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                action = {t["term"]: t["action"] for t in wanted}
                words = words_of(text, [(a, b) for _, a, b, _ in base_spans(text)])
                out.append([{"start": a, "end": b, "action": action[w]} for a, b, w in words if w in action])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(span))], ["blob", "added"])

    return texts.select("blob", "text", "terms").mapInArrow(run, f"blob string, added {spans}")


def private_spans(
    documents: DataFrame,
    window: int = WINDOW,
    support: int = SUPPORT,
    remove_bits: float = REMOVE_BITS,
    generalise_bits: float = GENERALISE_BITS,
) -> DataFrame:
    """(doc_id, blob, base, added) of every row of ``documents(doc_id, text)``.

    ``base`` has the spans (kind, start, end) of the patterns by kind, then start, offsets in code
    points; ``added`` the places of disclosing terms outside them. Null and empty texts have none.
    Repeated rows, ids or not, get the same spans as often as they come. A word that is near an
    entity several times counts once per text. Terms are runs of letters and digits of any length,
    A-Z lower-cased. Very long texts are read whole. An empty table gives no rows; other columns
    are not read.
    """
    ship(documents.sparkSession)
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    texts = texts.withColumn("blob", F.sha2("text", 256))
    found = stage(find_base(texts, window), "pii-base")
    terms = disclosing_terms(texts.select("blob", "text"), found, support, remove_bits, generalise_bits)
    # a term that reveals one entity is removed, if it must be generalised for another or not
    chosen = stage(terms.groupBy("term").agg(F.max("action").alias("action")), "pii-terms")
    added = locate(texts.select("blob", "text"), chosen)
    none = F.array().cast("array<struct<start:int,end:int,action:string>>")
    return found.join(added, "blob", "left").select("doc_id", "blob", "base", F.coalesce("added", none).alias("added"))


def digest(report: DataFrame) -> DataFrame:
    """Counts per kind, the SHA-256 of the base spans and all spans as ``kind:start:end`` text; terms come last."""
    names = F.array(*map(F.lit, KINDS))
    base = F.transform("base", lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"]))
    terms = F.transform("added", lambda s: F.concat_ws(":", F.lit(TERM), s["start"], s["end"]))

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{KINDS[kind]}")

    return report.select(
        "doc_id",
        *[count(k) for k in range(len(KINDS))],
        F.sha2(F.array_join(base, ","), 256).alias("base_sha256"),
        F.array_join(F.concat(base, terms), ",").alias("spans"),
    )


def sort_of(word: str) -> str:
    """What a generalised word becomes."""
    if word.isdigit():
        return "[number]"
    return "[name]" if word[:1].isupper() else "[word]"


def cleaned(text: str, base: list[dict], added: list[dict]) -> str:
    """The text with entities replaced by their kind, terms removed or generalised; overlaps go to the earlier span."""
    changes = [(s["start"], s["end"], f"[{KINDS[s['kind']]}]") for s in base]
    changes += [(s["start"], s["end"], "" if s["action"] == "remove" else sort_of(text[s["start"] : s["end"]])) for s in added]
    parts, at = [], 0
    for start, end, shown in sorted(changes):
        if start >= at:
            parts += [text[at:start], shown]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def sanitise(documents: DataFrame, **options: float) -> DataFrame:
    """``documents`` with personal data and disclosing terms taken out of ``text``; rows without stay as they are.

    Every column is kept, whatever its name; only ``text`` changes, null texts stay null. Options as in
    ``private_spans``.
    """
    report = private_spans(documents, **options).where((F.size("base") > 0) | (F.size("added") > 0))
    spans = stage(report.groupBy("blob").agg(F.first("base").alias("base"), F.first("added").alias("added")), "pii-spans")
    bloom, blocks = _bloom(spans.select(F.col("blob").alias("key")), spans.count())
    packed = documents.select(F.struct("*").alias("doc"), F.sha2(whole_text(), 256).alias("blob"))
    marked = flag_possible(packed, "blob", bloom, blocks, "_may")
    joined = marked.where("_may").join(spans, "blob", "left").select("doc", F.col("doc.text").alias("text"), "base", "added")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)), strict=True)
            texts = [t if t is None or b is None else cleaned(t, b, a) for t, b, a in rows]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc", "text"])

    changed = joined.mapInArrow(run, packed.select("doc", F.lit("").alias("text")).schema)
    whole = changed.select(F.col("doc").withField("text", F.col("text")).alias("doc"))
    return marked.where("NOT _may").select("doc").unionByName(whole).select("doc.*")
