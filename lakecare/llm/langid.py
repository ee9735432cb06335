"""Language identification by error-correcting output codes.

Every language has a codeword; each of its bits is predicted by a binary classifier over
hashed character n-grams of the whole text, and the language whose codeword has the least loss
wins, each bit counting by how well its classifier does. Close calls are flagged.

Only the fit uses a sample: at most ``per_language`` labelled rows per language, taken by hash.
Prediction reads every text whole, with one small weight table per task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakecare.llm.common import ship

FEATURES = 4096
ORDERS = (1, 2, 3)
#: Labelled rows that the fit looks at: per language, and about as many altogether.
PER_LANGUAGE, FIT_ROWS = 500, 64_000
UNKNOWN = "und"
#: Relative distance between the best and the second-best codeword below which a call is ambiguous.
CLOSE = 0.05

_LETTERS: list[np.ndarray] = []


def letters() -> np.ndarray:
    """For each code point its lower-case letter, or 0 if it is none."""
    if not _LETTERS:
        table = np.zeros(0x110000, np.uint32)
        for i in range(0x110000):
            c = chr(i)
            if c.isalpha():
                table[i] = ord(c.lower()[0])
        _LETTERS.append(table)
    return _LETTERS[0]


def ngram_counts(text: str) -> np.ndarray | None:
    """Counts of hashed letter n-grams with word edges; None if the text has no letter."""
    codes = letters()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")]
    if not codes.any():
        return None
    padded = np.concatenate([[0], codes, [0, 0, 0]]).astype(np.uint32)
    inside = padded[1:-2] > 0
    total = np.zeros(FEATURES)
    shift = np.uint32(32 - (FEATURES - 1).bit_length())
    for order in ORDERS:
        mixed = np.full(len(padded) - 3, order * 0x9E3779B1 & 0xFFFFFFFF, np.uint32)
        for i in range(order):  # starts one before each letter, so the first n-gram of a word holds its edge
            mixed = (mixed ^ padded[i : i + len(mixed)]) * np.uint32(0x85EBCA6B)
            mixed ^= mixed >> np.uint32(15)
        keep = inside | (padded[: len(mixed)] > 0) if order > 1 else padded[: len(mixed)] > 0
        total += np.bincount(((mixed * np.uint32(0xC2B2AE35)) >> shift)[keep], minlength=FEATURES)
    return total


def unit(counts: np.ndarray) -> np.ndarray:
    rooted = np.sqrt(counts)
    return rooted / np.linalg.norm(rooted)


def codewords(count: int, seed: int = 7) -> np.ndarray:
    """One row of -1 and 1 per class: all distinct splits of up to seven classes, else the best-spread random ones."""
    if count <= 7:
        splits = [[1 if k >> i & 1 else -1 for i in range(count)] for k in range(1, 1 << max(count - 1, 1))]
        return np.array(splits).T.astype(float)
    random, length = np.random.default_rng(seed), int(np.ceil(10 * np.log2(count)))
    best, spread = None, -1
    for _ in range(50):
        code = random.choice([-1.0, 1.0], (count, length))
        apart = (length - code @ code.T) / 2
        least = apart[~np.eye(count, dtype=bool)].min()
        if least > spread:
            best, spread = code, least
    return best


@dataclass
class LanguageModel:
    languages: list[str]
    code: np.ndarray  # languages x bits
    weights: np.ndarray  # features x bits
    bias: np.ndarray
    trust: np.ndarray  # of each bit; the mean is one

    def predict(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of the best language, score and ambiguity of each row."""
        margins = vectors @ self.weights + self.bias
        losses = (np.logaddexp(0, -margins[:, None, :] * self.code[None]) * self.trust).sum(-1)
        best = losses.argmin(1)
        ranked = np.sort(losses, 1)
        chances = np.exp(ranked[:, :1] - losses)
        score = np.round(1 / chances.sum(1), 9)  # sums may differ in the last bit from batch to batch
        if len(self.languages) == 1:
            return best, score, np.zeros(len(best), bool)
        close = (ranked[:, 1] - ranked[:, 0]) < CLOSE * (ranked[:, 1] + ranked[:, 0])
        return best, score, close


def fit(vectors: np.ndarray, labels: list[str], rounds: int = 200, ridge: float = 1e-4) -> LanguageModel:
    """Logistic bit classifiers by accelerated gradient descent; classes weigh alike."""
    languages = sorted(set(labels))
    code = codewords(len(languages))
    at = np.array([languages.index(x) for x in labels])
    target = code[at]
    share = 1 / np.bincount(at)[at] / len(languages)
    x = vectors.astype(np.float32, copy=False)
    weights, bias = np.zeros((x.shape[1], code.shape[1]), np.float32), np.zeros(code.shape[1], np.float32)
    ahead, ahead_bias = weights, bias
    rate = 16.0
    for k in range(rounds):
        pull = -target / (1 + np.exp(np.clip(target * (x @ ahead + ahead_bias), -50, 50))) * share[:, None]
        new = ahead - rate * (x.T @ pull.astype(np.float32) + ridge * ahead)
        new_bias = ahead_bias - rate * 0.05 * pull.sum(0).astype(np.float32)
        momentum = k / (k + 3)
        ahead, ahead_bias = new + momentum * (new - weights), new_bias + momentum * (new_bias - bias)
        weights, bias = new, new_bias
    right = ((x @ weights + bias) * target > 0).astype(float)
    trust = np.maximum((right * share[:, None]).sum(0) - 0.5, 0.01)
    return LanguageModel(languages, code, weights.astype(float), bias.astype(float), trust / trust.mean())


def train(labelled: DataFrame, per_language: int = PER_LANGUAGE) -> LanguageModel | None:
    """A model of all languages in ``labelled(doc_id, text, lang)``; None if there is no usable row.

    The sample holds about ``per_language`` rows per language, fewer if all languages together would
    come to more than ``FIT_ROWS``, and never more than twice that, but at least a row expected of each.
    """
    ship(labelled.sparkSession)
    usable = labelled.where("lang IS NOT NULL AND text IS NOT NULL")
    counts = usable.groupBy("lang").count().orderBy("lang").collect()
    if not counts:
        return None
    per_language = max(1, min(per_language, FIT_ROWS // len(counts)))
    rates = F.create_map(*[F.lit(x) for r in counts for x in (r["lang"], min(1.0, per_language / r["count"]))])
    place = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / float(1 << 30)
    sample = usable.where(place < rates[F.col("lang")]).select("lang", "text")

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(lang.as_py(), ngram_counts(text.as_py())) for lang, text in zip(*batch.columns, strict=True)]
            found = [(lang, np.flatnonzero(c), c) for lang, c in rows if c is not None]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([f[0] for f in found], pa.string()),
                    pa.array([f[1] for f in found], pa.list_(pa.int32())),
                    pa.array([f[2][f[1]] for f in found], pa.list_(pa.float64())),
                ],
                ["lang", "at", "n"],
            )

    most = 2 * per_language * len(counts)
    found = sample.mapInArrow(vectors, "lang string, at array<int>, n array<double>").limit(most).toArrow().combine_chunks()
    if not found.num_rows:
        return None
    return fit(*_table(found))


def _table(found: pa.Table) -> tuple[np.ndarray, list[str]]:
    """Unit vectors of ``found(lang, at, n)`` and their languages, in an order of their own.

    The driver holds the sample as it came and one table in the fit's precision: no Python object per
    feature, no table of doubles beside it. Big-endian bytes sort like the numbers they hold.
    """
    langs = found.column("lang").to_pylist()
    at, n = (found.column(c).combine_chunks() for c in ("at", "n"))
    cells = [(at[i].values.to_numpy(), n[i].values.to_numpy()) for i in range(len(langs))]
    order = sorted(range(len(langs)), key=lambda i: (langs[i], cells[i][0].astype(">u4").tobytes(), cells[i][1].astype(">f8").tobytes()))
    table = np.zeros((len(langs), FEATURES), np.float32)
    for row, i in enumerate(order):
        counts = np.zeros(FEATURES)
        counts[cells[i][0]] = cells[i][1]
        table[row] = unit(counts)
    return table, [langs[i] for i in order]


RESULT = "lang_pred string, score double, ambiguous boolean"


def identify(documents: DataFrame, model: LanguageModel | None, chunk: int = 512) -> DataFrame:
    """All columns but the text of every row, with lang_pred, score in [0, 1] and ambiguous.

    A null or empty text, one without a letter, and any text without a model give ``und`` with score 0,
    not ambiguous. Texts of any length are read whole. Of two languages equally near, the first by
    name is predicted, and flagged. Repeated rows are predicted alike, an empty table gives no rows.
    No column but the text bears on a prediction; columns named like the results give way to them.
    """
    spark = documents.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)
    kept = [c for c in documents.columns if c != "text" and c not in RESULT_NAMES]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, chunk):
                part = batch.slice(at, chunk)
                texts = part.column(len(kept)).to_pylist()
                langs, scores, close = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), bool)
                found = [(i, c) for i, t in enumerate(texts) if t and fitted and (c := ngram_counts(t)) is not None]
                if found:
                    rows = [i for i, _ in found]
                    best, scores[rows], close[rows] = fitted.predict(np.stack([unit(c) for _, c in found]))
                    for i, b in zip(rows, best, strict=True):
                        langs[i] = fitted.languages[b]
                out = [pa.array(langs, pa.string()), pa.array(scores), pa.array(close)]
                yield pa.RecordBatch.from_arrays([*part.columns[: len(kept)], *out], [*kept, *RESULT_NAMES])

    carried = documents.select(*[F.col(f"`{c}`") for c in kept], "text")
    schema = StructType([*carried.schema.fields[:-1], *StructType.fromDDL(RESULT).fields])
    return carried.mapInArrow(run, schema)


RESULT_NAMES = ("lang_pred", "score", "ambiguous")
