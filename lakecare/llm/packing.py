"""Packing of tokenised documents into fixed-length sequences, balanced by attention cost.

A piece of ``n`` tokens costs ``linear * n + quadratic * n * n``. Within one group of documents,
taken in descending length, each piece goes to the sequence of the lowest cost that still has
room for it; a piece that fits nowhere whole is cut to fill the cheapest sequence with room left.

A group is about a million tokens of neighbouring documents in one task, so tokens never leave
the task that made them: no shuffle, and memory bounded by a group and one Arrow batch. As many
sequences are opened as the group's tokens fill, so all of them end full; what is left over moves
on to the task's next group, and at the end of a task it is cut at powers of two.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

from lakecare.llm.common import ship, whole_text

CAPACITY = 4096
END_OF_DOCUMENT = 2
LINEAR, QUADRATIC = 1.0, 1.0 / 2048
GROUP_TOKENS = 1 << 20
#: Known words that a worker keeps; beyond it the less used half is forgotten.
WORD_MEMORY = 350_000
#: Texts tokenised together; what a batch needs besides its texts grows with them.
TEXTS_AT_ONCE = 500
#: Chunks whose normal form is their lower case, whatever stands beside them: letters of one code point up
#: to U+00FF, then marks that join with no letter and begin no special token.
PLAIN = (
    r"^(?P<head>[A-Za-z\x{C0}-\x{D6}\x{D8}-\x{DE}\x{DF}-\x{F6}\x{F8}-\x{FF}]+)"
    r"(?P<marks>[!\"#$%&()*+,./:;=?@\[\\\]^_`{}~-]*)$"
)

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, cost double"
)


class ChunkTokenizer:
    """Token ids of whole texts, from remembered ids of the words and marks in their space-separated chunks.

    The tokenizer drops white space and never joins across it, so the ids of a text are those of its
    chunks in order. A chunk of plain letters with ASCII marks after it is a word and a run of marks to
    the tokenizer. Lower-cased words go to the model alone, in the byte alphabet that the
    pre-tokenizer would give them. All other chunks, special tokens among them, take the full tokenizer.
    """

    def __init__(self, path: str, memory: int = WORD_MEMORY) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.memory = memory
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in set(printable)]
        alphabet = {b: chr(256 + i) for i, b in enumerate(others)}
        self.bytes_of = {c: chr(c).encode().decode("latin-1").translate(alphabet) for c in range(0xDF, 0x100)}
        self.known: dict[str, int] = {}
        self.starts, self.lengths, self.uses = (np.zeros(0, np.int64) for _ in range(3))
        self.flat = np.zeros(0, np.uint32)

    def _keep_frequent(self) -> None:
        """Forget all but the half of the memory that was used most; ties go to the words learnt first."""
        kept = np.sort(np.argsort(-self.uses, kind="stable")[: self.memory // 2])
        lengths = self.lengths[kept]
        begins = np.cumsum(lengths) - lengths
        self.flat = self.flat[np.repeat(self.starts[kept] - begins, lengths) + np.arange(lengths.sum())]
        self.starts, self.lengths, self.uses = begins, lengths, self.uses[kept] // 2
        words = list(self.known)
        self.known = {words[k]: i for i, k in enumerate(kept.tolist())}

    def _learn(self, words: pa.Array, plain: pa.Array) -> np.ndarray:
        """Remember the ids of new words: plain ones in lower case, marks, or whole chunks; their places."""
        narrow = pc.string_is_ascii(words)
        kinds = [pc.and_(plain, narrow), pc.and_(plain, pc.invert(narrow)), pc.invert(plain)]
        groups = [strings(words.filter(k)) for k in kinds]
        spelt = groups[0] + ("\n".join(groups[1]).translate(self.bytes_of).split("\n") if groups[1] else [])
        model = self.tokenizer.model.tokenize
        ids = [[t.id for t in model(w)] for w in spelt]
        ids += [e.ids for e in self.tokenizer.encode_batch_fast(groups[2], add_special_tokens=False)]
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        first = len(self.lengths)
        self.known.update(zip(itertools.chain(*groups), range(first, first + len(ids)), strict=True))
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(lengths) - lengths])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.uses = np.concatenate([self.uses, np.zeros(len(ids), np.int64)])
        self.flat = np.concatenate([self.flat, np.fromiter(itertools.chain(*ids), np.uint32, int(lengths.sum()))])
        order = np.concatenate([np.flatnonzero(k.to_numpy(zero_copy_only=False)) for k in kinds])
        places = np.empty(len(ids), np.int64)
        places[order] = first + np.arange(len(ids))
        return places

    def _places(self, words: pa.Array, plain: pa.Array) -> np.ndarray:
        """Where each of the distinct words is remembered, new ones now too."""
        listed, known = strings(words), self.known
        places = np.fromiter((known.get(w, -1) for w in listed), np.int64, len(listed))
        new = np.flatnonzero(places < 0)
        if len(new):
            places[new] = self._learn(words.take(pa.array(new)), plain.take(pa.array(new)))
        return places

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of ``texts`` in one array, and where each text's ids begin (one entry more than texts)."""
        if len(self.known) > self.memory:
            self._keep_frequent()
        spaced = pc.replace_substring(texts.cast(pa.large_string()), "\n", " ")
        lists = pc.split_pattern(spaced, " ")
        coded = lists.values.dictionary_encode()
        parts = pc.extract_regex(coded.dictionary, PLAIN)
        head = pc.utf8_lower(pc.struct_field(parts, "head"))
        # two pieces to a chunk: its word, or all of it; its marks, if it is a word
        words = pc.coalesce(head, coded.dictionary).dictionary_encode()
        marks = pc.fill_null(pc.struct_field(parts, "marks"), "").dictionary_encode()
        of_word = words.indices.to_numpy(zero_copy_only=False)
        plain = np.zeros(len(words.dictionary), bool)
        plain[of_word] = head.is_valid().to_numpy(zero_copy_only=False)
        first = self._places(words.dictionary, pa.array(plain))[of_word]
        second = self._places(marks.dictionary, pa.array(np.zeros(len(marks.dictionary), bool)))
        second = second[marks.indices.to_numpy(zero_copy_only=False)]
        pieces = np.stack([first, second], 1)[coded.indices.to_numpy(zero_copy_only=False)].ravel()
        self.uses += np.bincount(pieces, minlength=len(self.uses))
        lengths = self.lengths[pieces]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.flat[np.repeat(self.starts[pieces] - ends + lengths, lengths) + np.arange(total)]
        return ids, np.concatenate([[0], ends])[2 * lists.offsets.to_numpy()]


def strings(values: pa.Array) -> list[str]:
    return values.to_numpy(zero_copy_only=False).tolist()


@dataclass
class Bins:
    """Open sequences of one group."""

    count: int
    capacity: int
    linear: float
    quadratic: float
    cost: np.ndarray = field(init=False)
    room: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        self.cost, self.room = np.zeros(self.count), np.full(self.count, self.capacity)

    def place(self, length: int) -> list[tuple[int, int, int, float]]:
        """(sequence, offset, tokens, cost) for each piece of a run of ``length`` tokens."""
        pieces = []
        while length:
            fits = self.room >= min(length, self.capacity)
            whole = fits if fits.any() else self.room > 0
            at = int(np.argmin(np.where(whole, self.cost, np.inf)))
            if self.room[at] == 0:
                break
            taken = min(length, int(self.room[at]))
            cost = self.linear * taken + self.quadratic * taken * taken
            pieces.append((at, self.capacity - int(self.room[at]), taken, cost))
            self.cost[at] += cost
            self.room[at] -= taken
            length -= taken
        return pieces


class Packer:
    def __init__(self, task: int, capacity: int, linear: float, quadratic: float) -> None:
        self.base, self.used = task << 32, 0
        self.capacity, self.linear, self.quadratic = capacity, linear, quadratic
        self.rows: list[tuple] = []
        self.runs: list[tuple[int | None, int, int, np.ndarray]] = []  # id, ids before, the document's ids, ids
        self.tokens = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.runs.append((doc_id, 0, len(ids), ids))
        self.tokens += len(ids)

    def _emit(self, run: tuple, skipped: int, length: int, sequence: int, offset: int, cost: float) -> None:
        doc_id, before, total, ids = run
        crc = zlib.crc32(ids[skipped : skipped + length].astype("<u4").tobytes())
        self.rows.append((doc_id, before + skipped, length, crc, total, self.base + sequence, offset, cost))

    def pack(self) -> None:
        """Fill as many sequences as the tokens at hand fill; keep the rest."""
        bins = Bins(self.tokens // self.capacity, self.capacity, self.linear, self.quadratic)
        left = []
        for run in sorted(self.runs, key=lambda r: -len(r[3])) if bins.count else self.runs:
            done = 0
            for at, offset, taken, cost in bins.place(len(run[3])) if bins.count else []:
                self._emit(run, done, taken, self.used + at, offset, cost)
                done += taken
            if done < len(run[3]):
                left.append((run[0], run[1] + done, run[2], run[3][done:]))
        self.used += bins.count
        self.runs, self.tokens = left, sum(len(r[3]) for r in left)

    def finish(self) -> None:
        """Cut what is left into sequences whose lengths are falling powers of two."""
        self.pack()
        size, offset, left = 0, 0, self.tokens
        for run in self.runs:
            done = 0
            while done < len(run[3]):
                if offset == size:
                    size, offset = 1 << (left.bit_length() - 1), 0
                    self.used += 1
                taken = min(len(run[3]) - done, size - offset)
                cost = self.linear * taken + self.quadratic * taken * taken
                self._emit(run, done, taken, self.used - 1, offset, cost)
                done, offset, left = done + taken, offset + taken, left - taken
        self.runs, self.tokens = [], 0

    def drain(self, schema: pa.Schema) -> pa.RecordBatch:
        columns = list(zip(*self.rows, strict=True)) or [[] for _ in schema]
        self.rows = []
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
        )


_TOKENIZERS: dict[str, ChunkTokenizer] = {}


def tokenizer_at(path: str) -> ChunkTokenizer:
    """One tokenizer per worker and file."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = ChunkTokenizer(path)
    return _TOKENIZERS[path]


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def pack_documents(
    documents: DataFrame,
    tokenizer_path: str | None = None,
    capacity: int = CAPACITY,
    linear: float = LINEAR,
    quadratic: float = QUADRATIC,
    group_tokens: int = GROUP_TOKENS,
) -> DataFrame:
    """One row per piece (columns of ``PIECES``) of every row of ``documents(doc_id, text, ...)``.

    Null and empty texts are documents of the closing token alone; repeated rows are packed as
    often as they come; a null doc_id is kept; other columns are not read; an empty table gives
    no pieces. A sequence's number is its task's number times 2**32 plus a count. The tokenizer
    file is read on the executors and must lie at the same place there.
    """
    ship(documents.sparkSession)
    path = tokenizer_path or default_tokenizer()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = tokenizer_at(path)
        packer = Packer(TaskContext.get().partitionId(), capacity, linear, quadratic)
        fields = [("doc_id", pa.int64())] + [(n, pa.int64()) for n in "start length ids_crc32 doc_tokens".split()]
        schema = pa.schema([*fields, ("sequence_id", pa.int64()), ("offset", pa.int64()), ("cost", pa.float64())])
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
                part = batch.slice(at, TEXTS_AT_ONCE)
                ids, begins = tokenizer.encode(part.column(1))
                for k, doc_id in enumerate(part.column(0).to_pylist()):
                    packer.add(doc_id, np.append(ids[begins[k] : begins[k + 1]], np.uint32(END_OF_DOCUMENT)))
                    if packer.tokens >= group_tokens:
                        packer.pack()
                        yield packer.drain(schema)
        packer.finish()
        yield packer.drain(schema)

    return documents.select("doc_id", whole_text().alias("text")).mapInArrow(run, PIECES)
