"""Toxicity by a support vector machine over a gapped subsequence kernel with Nyström landmarks.

Two strings are alike by the three-character subsequences they share; each character left out
inside one costs a factor, so an insult with inserted characters or gaps stays near the plain
one. A text's units are its words without punctuation, runs of single letters joined to one
word, and windows over very long words. A text is judged by its worst three units, and by how
many and how large a share of them lie on the toxic side.

The labels are per text, so the units that make a text toxic are found while learning: each
round takes the toxic texts' worst units as positives and the clean texts' units as negatives,
weighing each by how many texts of its class hold it. The Nyström map over the landmarks is linear in their subsequences, so the fitted machine folds
into one table of weights per subsequence, and scoring is a lookup.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakecare.llm.common import ship, whole_text

TABLE_BITS = 20
DECAY = 0.6
#: Offsets of the second and third character of a subsequence: up to two characters are left out.
OFFSETS = ((1, 2), (1, 3), (2, 3), (1, 4), (2, 4), (3, 4))
LONGEST, STEP = 24, 12
LANDMARKS = 256
#: Labelled rows of each class that the fit looks at.
TOXIC_ROWS, CLEAN_ROWS = 1000, 2000
EDGE = 1
#: Log odds beyond which a unit that many toxic texts hold counts as a witness in all of them.
TELLING = 3.0


def _windows(word: str) -> list[str]:
    if len(word) <= LONGEST:
        return [word]
    return [word[i : i + LONGEST] for i in range(0, len(word) - LONGEST + STEP, STEP)]


@dataclass
class Units:
    """Distinct units of a batch of texts, and which text each occurrence belongs to."""

    words: list[str]
    text: np.ndarray
    unit: np.ndarray


def units_of(texts: pa.Array) -> Units:
    spaced = pc.replace_substring_regex(texts.cast(pa.large_string()), r"[\t\n\v\f\r\x{85}\x{A0}\x{2028}\x{2029}]", " ")
    lists = pc.split_pattern(spaced, " ")
    coded = lists.values.dictionary_encode()
    index = coded.indices.to_numpy(zero_copy_only=False)
    owner = np.repeat(np.arange(len(texts)), np.diff(lists.offsets.to_numpy()))
    plain = pc.replace_substring_regex(pc.utf8_lower(coded.dictionary), r"[^\p{L}\p{M}\p{N}]+", "").to_pylist()
    length = np.fromiter(map(len, plain), np.int64, len(plain))
    words, long = list(plain), np.flatnonzero(length > LONGEST)
    more_text, more_unit = [], []
    for w in long.tolist():
        cut = _windows(plain[w])
        places = np.unique(owner[index == w])
        for piece in cut:
            words.append(piece)
            more_text.append(places)
            more_unit.append(np.full(len(places), len(words) - 1))
        words[w] = ""
    single = (length == 1)[index] if len(index) else np.zeros(0, bool)
    edges = np.flatnonzero(np.diff(np.concatenate([[False], single, [False]])))
    for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        for text in np.unique(owner[a:b]).tolist() if b - a >= 3 else []:
            run = "".join(plain[i] for i in index[a:b][owner[a:b] == text])
            for piece in _windows(run) if len(run) >= 3 else []:
                words.append(piece)
                more_text.append(np.array([text]))
                more_unit.append(np.array([len(words) - 1]))
    text = np.concatenate([owner, *more_text]).astype(np.int64)
    return Units(words, text, np.concatenate([index, *more_unit]).astype(np.int64))


def subsequences(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, key, value) of every subsequence; values make each word's norm at most one."""
    joined = "\x01" + "\x01\x01\x01\x01".join(words) + "\x01\x01\x01\x01"
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint32)
    length = np.fromiter(map(len, words), np.int64, len(words)) + 2  # with both edges
    first = np.cumsum(length + 2) - (length + 2)
    norm = np.zeros(len(words))
    found = []
    for a, b in OFFSETS:
        starts = np.maximum(length - b, 0)
        value = DECAY ** (b - 2)
        norm += starts * value * value
        owner = np.repeat(np.arange(len(words)), starts)
        at = np.repeat(first - (np.cumsum(starts) - starts), starts) + np.arange(starts.sum())
        key = codes[at] * np.uint32(0x9E3779B1) ^ codes[at + a] * np.uint32(0x85EBCA6B)
        key = (key ^ (key >> np.uint32(13))) * np.uint32(0xC2B2AE35) + codes[at + b] * np.uint32(0x27D4EB2F)
        key = (key ^ (key >> np.uint32(15))) * np.uint32(0x2C1B3C6D) >> np.uint32(32 - TABLE_BITS)
        found.append((owner, key, np.full(len(owner), value)))
    owner, key, value = (np.concatenate(x) for x in zip(*found, strict=True))
    return owner, key, value / np.sqrt(np.maximum(norm, 1e-9))[owner]


@dataclass
class ToxicityModel:
    table: np.ndarray  # weight of each subsequence
    bias: float
    judge: np.ndarray  # weights of the features of a text, and an offset

    def raw(self, words: list[str], step: int = 50_000) -> np.ndarray:
        out = []
        for i in range(0, len(words), step):
            part = words[i : i + step]
            owner, key, value = subsequences(part)
            out.append(np.bincount(owner, self.table[key] * value, minlength=len(part)) + self.bias)
        return np.concatenate(out) if out else np.zeros(0)

    def chance(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(features @ self.judge[:-1] + self.judge[-1], -500, 500)))


#: Scores below this count as this much.
FLOOR = -0.5
WORST = 3


def text_features(texts: int, text: np.ndarray, score: np.ndarray) -> np.ndarray:
    """Per text: its three highest unit scores, and number and share of units on the toxic side.

    ``text`` and ``score`` have one entry per occurrence of a unit.
    """
    units = np.bincount(text, minlength=texts)
    high = score > FLOOR
    text, score = text[high], score[high]
    order = np.lexsort((-score, text))
    text, score = text[order], score[order]
    rank = np.arange(len(text)) - np.searchsorted(text, text)
    out = np.full((texts, WORST + 2), FLOOR)
    top = rank < WORST
    out[text[top], rank[top]] = score[top]
    toxic = np.bincount(text, score > 0, minlength=texts)
    out[:, WORST] = np.log1p(toxic)
    out[:, WORST + 1] = 10 * toxic / (units + 10)
    return out


def _rows(words: list[str], landmarks: list[str]) -> np.ndarray:
    """Kernel values of ``words`` against ``landmarks``."""
    owner, key, value = subsequences(landmarks)
    column = np.full(1 << TABLE_BITS, -1, np.int32)
    used = np.unique(key)
    column[used] = np.arange(len(used))
    basis = np.zeros((len(used), len(landmarks)))
    np.add.at(basis, (column[key], owner), value)
    owner, key, value = subsequences(words)
    known = column[key] >= 0
    owner, at, value = owner[known], column[key[known]], value[known]
    order = np.argsort(owner, kind="stable")
    owner, at, value = owner[order], at[order], value[order]
    out = np.zeros((len(words), len(landmarks)))
    heads = np.flatnonzero(np.diff(owner, prepend=-1))
    for lo, hi in zip(heads, [*heads[1:], len(owner)], strict=True):
        out[owner[lo]] = value[lo:hi] @ basis[at[lo:hi]]
    return out


def _machine(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float, rounds: int = 30) -> np.ndarray:
    """Linear SVM (squared hinge) by Newton steps; the last coordinate is the bias."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    keep = np.eye(len(w)) * ridge
    keep[-1, -1] = 1e-8
    for _ in range(rounds):
        inside = y * (x @ w) < 1
        a, c = x[inside], weight[inside][:, None]
        new = np.linalg.solve(keep + a.T @ (c * a), a.T @ (c[:, 0] * y[inside]))
        if np.allclose(new, w, atol=1e-7):
            break
        w = new
    return w


@dataclass
class Bag:
    """The distinct units of one labelled text, and how often each occurs."""

    units: np.ndarray
    times: np.ndarray
    toxic: int


def bag_features(bags: list[Bag], scores: np.ndarray) -> np.ndarray:
    text = np.concatenate([np.full(int(b.times.sum()), i) for i, b in enumerate(bags)])
    return text_features(len(bags), text, np.concatenate([np.repeat(scores[b.units], b.times) for b in bags]))


def fit(words: list[str], bags: list[Bag], rounds: int = 3, seed: int = 5) -> ToxicityModel:
    """Learn units from two thirds of ``bags`` and how to judge a text from the rest (from all, if they are few)."""
    toxic = [b for b in bags if b.toxic]
    clean = [b for b in bags if not b.toxic]
    apart = len(toxic) >= 60 and len(clean) >= 60
    learn = [b for group in (toxic, clean) for i, b in enumerate(group) if not apart or i % 3]
    table, bias = fit_units(words, learn, rounds, seed)
    model = ToxicityModel(table, bias, np.zeros(0))
    rest = [b for group in (toxic, clean) for i, b in enumerate(group) if not apart or i % 3 == 0]
    model.judge = fit_judge(bag_features(rest, model.raw(words)), np.array([b.toxic for b in rest]))
    return model


def fit_units(words: list[str], bags: list[Bag], rounds: int, seed: int) -> tuple[np.ndarray, float]:
    random = np.random.default_rng(seed)
    held = np.zeros((2, len(words)))  # how many texts of each class hold a unit
    seen = np.zeros((2, 1 << TABLE_BITS), np.float32)
    for bag in bags:
        held[bag.toxic, bag.units] += 1
        seen[bag.toxic, np.unique(subsequences([words[w] for w in bag.units])[1])] += 1
    count = [sum(b.toxic == c for b in bags) for c in (0, 1)]
    # first guess: units whose subsequences are much more frequent among toxic texts
    odds = np.log((seen[1] + 0.5) / (count[1] + 1)) - np.log((seen[0] + 0.5) / (count[0] + 1))
    odds[seen.sum(0) < min(3, 1 + count[1] // 8)] = 0
    scores = ToxicityModel(odds, 0.0, np.zeros(0)).raw(words)
    # a text may hold several insults, of which its worst three would always be the same few words
    unit_odds = np.log((held[1] + 0.5) / (count[1] + 1)) - np.log((held[0] + 0.5) / (count[0] + 1))
    telling = (held[1] >= max(3, count[1] // 50)) & (unit_odds > TELLING)
    clean_words = np.flatnonzero(held[0])
    table, bias = np.zeros(1 << TABLE_BITS, np.float32), 0.0
    for step in range(rounds):
        witnesses: list[int] = []
        for bag in bags:
            if bag.toxic:
                best = bag.units[np.argsort(-scores[bag.units], kind="stable")[:WORST]]
                own = [w for k, w in enumerate(best.tolist()) if k == 0 or (step and scores[w] > 0)]
                witnesses += np.union1d(own, bag.units[telling[bag.units]]).astype(int).tolist()
        positive, times = np.unique(witnesses, return_counts=True)
        hard = clean_words[np.argsort(-scores[clean_words], kind="stable")[:3000]]
        others = np.setdiff1d(clean_words, hard)
        spread = random.choice(others, min(2000, len(others)), replace=False)
        top = positive[np.argsort(-times, kind="stable")]
        few = top[: LANDMARKS // 2].tolist()
        rest = np.unique(np.concatenate([top[LANDMARKS // 2 :], hard[: LANDMARKS // 2]]))
        few += random.choice(rest, min(LANDMARKS - len(few), len(rest)), replace=False).tolist()
        marks = [words[w] for w in dict.fromkeys(few)]
        values, vectors = np.linalg.eigh(_rows(marks, marks))
        good = values > 1e-6 * values.max()
        root = vectors[:, good] / np.sqrt(values[good])
        x = _rows([words[w] for w in np.concatenate([positive, hard, spread])], marks) @ root
        y = np.concatenate([np.ones(len(positive)), -np.ones(len(hard) + len(spread))])
        weight = np.concatenate(
            [times / count[1], held[0, hard] / count[0], np.full(len(spread), 5 / max(len(spread), 1))]
        )
        w = _machine(x, y, weight * 300, ridge=1.0)
        mark, key_, value_ = subsequences(marks)
        alpha = root @ w[:-1]
        table = np.bincount(key_, alpha[mark] * value_, minlength=1 << TABLE_BITS).astype(np.float32)
        bias = float(w[-1])
        scores = ToxicityModel(table, bias, np.zeros(0)).raw(words)
    return table, bias


def fit_judge(features: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Logistic regression with Platt's softened targets; both classes weigh alike."""
    n1, n0 = int((toxic == 1).sum()), int((toxic == 0).sum())
    target = np.where(toxic == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    weight = np.where(toxic == 1, 0.5 / n1, 0.5 / n0)
    x = np.hstack([features, np.ones((len(features), 1))])
    keep = np.diag([3e-4] * features.shape[1] + [1e-9])
    w = np.zeros(x.shape[1])
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        pull = x.T @ (weight * (p - target)) + keep @ w
        bend = (x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + keep
        move = np.linalg.solve(bend, pull)
        w = w - move * min(1.0, 3 / max(np.abs(move).max(), 1e-9))
        if np.abs(move).max() < 1e-8:
            break
    return w


def train(
    documents: DataFrame,
    labels: DataFrame | None = None,
    toxic_rows: int = TOXIC_ROWS,
    clean_rows: int = CLEAN_ROWS,
) -> ToxicityModel | None:
    """A model from ``documents(doc_id, text)`` and ``labels(doc_id, toxic)``; None unless both classes occur.

    Without ``labels`` the documents hold ``toxic`` themselves. The fit looks at ``toxic_rows``
    and ``clean_rows`` labelled rows, taken by a hash of the id (never at more than twice as
    many), with their distinct units. The chosen labels are that few, so they are broadcast and
    no text moves.
    """
    ship(documents.sparkSession)
    usable = (documents if labels is None else labels).where("toxic IN (0, 1)").select("doc_id", "toxic")
    counts = {r["toxic"]: r["count"] for r in usable.groupBy("toxic").count().collect()}
    if len(counts) < 2:
        return None
    most = 2 * (toxic_rows + clean_rows)
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    rate = F.when(F.col("toxic") == 1, toxic_rows / counts[1]).otherwise(clean_rows / counts[0])
    chosen = usable.where(place < rate).select("doc_id", F.col("toxic").cast("int").alias("toxic")).distinct().limit(most)
    texts = documents.select("doc_id", "text").where("text IS NOT NULL AND text <> ''")
    sample = texts.join(F.broadcast(chosen), "doc_id").select("toxic", "text")

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                units = units_of(part.column(1))
                pairs, times = np.unique(units.text * len(units.words) + units.unit, return_counts=True)
                text, unit = np.divmod(pairs, len(units.words))
                ends = np.searchsorted(text, np.arange(part.num_rows + 1)).tolist()
                spans = list(zip(ends[:-1], ends[1:], strict=True))
                words = [[units.words[u] for u in unit[a:b]] for a, b in spans]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(words, pa.list_(pa.string())),
                        pa.array([times[a:b] for a, b in spans], pa.list_(pa.int32())),
                    ],
                    ["toxic", "words", "times"],
                )

    rows = sample.mapInArrow(bags, "toxic int, words array<string>, times array<int>").limit(most).toArrow().to_pylist()
    number: dict[str, int] = {}
    bags_of = []
    rows.sort(key=lambda r: (r["toxic"], sorted(r["words"])), reverse=True)
    while rows:
        row = rows.pop()
        found = sorted((w, n) for w, n in zip(row["words"], row["times"], strict=True) if len(w) > 1)
        if found:
            units = np.array([number.setdefault(w, len(number)) for w, _ in found])
            bags_of.append(Bag(units, np.array([n for _, n in found]), row["toxic"]))
    if len({b.toxic for b in bags_of}) < 2:
        return None
    return fit(list(number), bags_of)


def score(documents: DataFrame, model: ToxicityModel | None, chunk: int = 4000) -> DataFrame:
    """All columns but ``text`` of every row, with score in [0, 1] and predicted (1 from 0.5 on).

    Null and empty texts, and all texts without a model, score as texts without any unit do.
    Repeated rows score alike, ties of units do not matter; texts of any length are read whole; an
    empty table gives no rows. Columns named like the results give way to them.
    """
    spark = documents.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)
    kept = [c for c in documents.columns if c not in ("text", "score", "predicted")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, chunk):
                part = batch.slice(at, chunk)
                chances = np.zeros(part.num_rows)
                if fitted is not None:
                    units = units_of(part.column(len(kept)))
                    scores = fitted.raw(units.words)
                    chances = fitted.chance(text_features(part.num_rows, units.text, scores[units.unit]))
                predicted = pa.array((chances >= 0.5).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[: len(kept)], pa.array(chances), predicted], [*kept, "score", "predicted"]
                )

    carried = documents.select(*[F.col(f"`{c}`") for c in kept], whole_text().alias("text"))
    schema = StructType([*carried.schema.fields[:-1], *StructType.fromDDL("score double, predicted int").fields])
    return carried.mapInArrow(run, schema)
