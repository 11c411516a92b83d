"""Sum-of-squares online packing of tokenized documents into fixed windows.

Each task packs the documents of its partition as they come.  Full windows are
cut from a document's front; the rest goes, whole, into the open window whose
new fill level gives the smallest sum of squared counts of partly filled
windows, with the counts in an array by level.  At the end, the emptiest open
window is taken apart again and again, and its pieces go into the others by the
same rule, cut where they are larger than every gap; the one window that stays
is cut at powers of two, which need no padding.

Nothing is shuffled, and a task holds only its open windows.  Results of a
rerun task are the same as long as its partition's rows come in the same order,
as from a written table.
"""

from __future__ import annotations

import re
import sys
import types
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship

ship(__name__)

#: Tokenized chunks that a Python worker keeps at most.
CACHE_CHUNKS = 1_000_000
SCHEMA = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, whole boolean"
)
#: Bytes of ids that an output batch holds before it is sent.
BATCH_BYTES = 8 << 20


@dataclass
class Piece:
    """A run of a document's ids (little-endian unsigned 32-bit), and where it starts."""

    doc_id: int | None
    start: int
    ids: bytes
    doc_tokens: int

    def __len__(self) -> int:
        return len(self.ids) // 4

    def cut(self, n: int) -> tuple[Piece, Piece]:
        """The first ``n`` ids, and the others."""
        return (
            Piece(self.doc_id, self.start, self.ids[: 4 * n], self.doc_tokens),
            Piece(self.doc_id, self.start + n, self.ids[4 * n :], self.doc_tokens),
        )


@dataclass
class SumOfSquares:
    """Open windows by fill level, and how many there are of each."""

    capacity: int
    counts: np.ndarray = field(init=False)
    windows: dict[int, list[list[Piece]]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.counts = np.zeros(self.capacity + 1, dtype=np.int64)

    def level_for(self, size: int, new: bool = True) -> int:
        """The level of the window to use, 0 for a new one (where ``new`` allows it, or no open one fits).

        A move from level h to h + size changes the sum of squares by
        2 (N[h + size] - N[h]) + 2, filling a window up by 1 - 2 N[h], and a new
        window by 2 N[size] + 1.  Ties go to the fuller window.
        """
        open_levels = np.flatnonzero(self.counts[: self.capacity - size + 1])
        if not len(open_levels):
            return 0
        here, after = self.counts[open_levels], self.counts[open_levels + size]
        change = np.where(open_levels + size == self.capacity, 1 - 2 * here, 2 * (after - here) + 2)
        best = len(change) - 1 - int(np.argmin(change[::-1]))
        return int(open_levels[best]) if not new or change[best] <= 2 * self.counts[size] + 1 else 0

    def take(self, level: int) -> list[Piece]:
        """An open window of the level, no longer open."""
        self.counts[level] -= 1
        return self.windows[level].pop()

    def place(self, piece: Piece, new: bool = True) -> list[Piece] | None:
        """Puts the piece; returns the window if that fills it."""
        level = self.level_for(len(piece), new)
        window = self.take(level) if level else []
        window.append(piece)
        level += len(piece)
        if level == self.capacity:
            return window
        self.windows.setdefault(level, []).append(window)
        self.counts[level] += 1
        return None

    def close(self) -> Iterator[list[Piece]]:
        """The open windows' pieces: full windows, and the rest of less than one cut at powers of two."""
        while self.counts.sum() > 1:
            for piece in self.take(int(np.flatnonzero(self.counts)[0])):
                while len(piece):
                    levels = np.flatnonzero(self.counts)
                    widest = self.capacity - int(levels[0]) if len(levels) else self.capacity
                    part, piece = piece.cut(min(len(piece), widest))
                    if full := self.place(part, new=False):
                        yield full
        rest = [piece for level in np.flatnonzero(self.counts) for piece in self.take(int(level))]
        left = sum(map(len, rest))
        while left:
            room = 1 << (left.bit_length() - 1)
            left -= room
            window = []
            while room:
                piece = rest[0]
                part, rest[0] = piece.cut(min(len(piece), room))
                if not len(rest[0]):
                    del rest[0]
                window.append(part)
                room -= len(part)
            yield window


def pack(pieces: Iterator[Piece], capacity: int) -> Iterator[list[Piece]]:
    """Windows of pieces: full, or closed at the end at a power of two."""
    state = SumOfSquares(capacity)
    for piece in pieces:
        while len(piece) >= capacity:
            full, piece = piece.cut(capacity)
            yield [full]
        if len(piece) and (window := state.place(piece)):
            yield window
    yield from state.close()


#: Punctuation that a plain chunk may end in.
MARKS = b",.;:!?"
#: A word of ASCII and Latin-1 letters (its UTF-8), lower-cased A-Z.
PLAIN = re.compile(rb"(?:[a-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")
#: The characters that byte-level models have for the bytes of such letters, where they are other than Latin-1's.
BYTE_CHARS = [(chr(b), chr(256 + n)) for n, b in enumerate([*range(33), *range(127, 161), 173]) if b >= 128]


class ChunkEncoder:
    """Ids of a text as packed integers, each chunk between ASCII white space encoded once.

    For tokenizers that drop white space and case, and that take a run of
    letters, and one of punctuation after it, for a unit each: then a text's ids
    are those of its chunks, and a plain chunk's are those of its two runs.  A
    run of letters goes to the model alone, in its bytes' characters; pieces
    that end a unit are marked there.
    """

    @staticmethod
    def of_worker(path: str) -> ChunkEncoder:
        """The encoder of this Python worker, kept between its tasks, so that a word is learnt once a worker."""
        kept = sys.modules.setdefault("cdrflow_of_worker", types.ModuleType("cdrflow_of_worker")).__dict__
        if path not in kept:
            kept[path] = ChunkEncoder(path)
        return kept[path]

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.model = Tokenizer(self.tokenizer.model)
        self.model.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        vocabulary, mark = self.tokenizer.get_vocab(), self.tokenizer.model.end_of_word_suffix
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for piece, i in vocabulary.items() if mark and piece.endswith(mark)]] = True
        self.known: dict[bytes, bytes] = {}
        alike = [bytes([97 + i, 97 + j]) + c.encode() for i in range(26) for j in range(26) for c in ("", "éÀÖØöøÿ", "ing")]
        if list(self._by_model(alike)) != list(self._encode(alike)):
            raise ValueError("this tokenizer does not take a run of letters for a unit, or is not of bytes")

    def _encode(self, chunks: list[bytes]) -> Iterator[bytes]:
        for e in self.tokenizer.encode_batch([c.decode() for c in chunks], add_special_tokens=False):
            yield np.asarray(e.ids, dtype="<u4").tobytes()

    def _by_model(self, words: list[bytes]) -> Iterator[bytes]:
        """Ids of runs of letters, many at once."""
        for i in range(0, len(words), 2000):
            some = words[i : i + 2000]
            text = b" ".join(some).decode().lower().encode().decode("latin-1")
            for byte, char in BYTE_CHARS:
                text = text.replace(byte, char)
            (line,) = self.model.encode_batch_fast([text], add_special_tokens=False)
            ids = np.asarray(line.ids, dtype="<u4")
            ends = np.concatenate([[0], np.flatnonzero(self.ends[ids]) + 1]) * 4
            if len(ends) != len(some) + 1 or ends[-1] != 4 * len(ids):
                raise ValueError("this tokenizer's model has no ids for some letters")
            packed, at = ids.tobytes(), ends.tolist()
            yield from (packed[a:b] for a, b in zip(at, at[1:]))

    def _learn(self, chunks: list[bytes]) -> None:
        known, plain, odd = self.known, [], []
        for c in chunks:
            word = c.rstrip(MARKS)
            if word.isalpha() or PLAIN.fullmatch(word):
                plain.append((c, word))
            else:
                odd.append(c)
        marks = [mark for mark in {c[len(word) :] for c, word in plain} if mark and mark not in known]
        known.update(zip([*odd, *marks], self._encode([*odd, *marks])))
        words = [word for word in {word for _, word in plain} if word not in known]
        known.update(zip(words, self._by_model(words)))
        known.update((c, known[word] + known[c[len(word) :]]) for c, word in plain if len(c) > len(word))

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        chunks = [(t or "").encode().lower().split() for t in texts]  # A-Z, as the tokenizer does itself
        if len(self.known) > CACHE_CHUNKS:
            self.known.clear()
        self._learn(list(set().union(*chunks).difference(self.known)))
        return [b"".join(map(self.known.__getitem__, cs)) for cs in chunks]


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int,
    capacity: int = 4096,
    id_col: str = "doc_id",
    text_col: str = "text",
    encoder: Callable[[str], Callable[[list], list[bytes]]] = ChunkEncoder.of_worker,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids, doc_tokens, sequence_id, offset, whole.

    A document is its text's ids and ``end_id``; a null or empty text is just
    ``end_id``, a null id stays null.  Every id lies in one piece.  ``whole``
    says that the document was not cut.  An empty table gives no rows; other
    columns are not read.
    """
    end = int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encode = encoder(tokenizer_path)

        def pieces() -> Iterator[Piece]:
            for batch in batches:
                for i in range(0, batch.num_rows, 256):
                    part = batch.slice(i, 256)
                    for doc_id, ids in zip(
                        part.column(0).to_pylist(), encode(part.column(1).to_pylist()), strict=True
                    ):
                        yield Piece(doc_id, 0, ids + end, len(ids) // 4 + 1)

        first_id = TaskContext.get().partitionId() << 32
        schema = pa.schema(
            [(c, pa.int64()) for c in ("doc_id", "start", "length")]
            + [("ids", pa.binary())]
            + [(c, pa.int64()) for c in ("doc_tokens", "sequence_id", "offset")]
            + [("whole", pa.bool_())]
        )
        rows: list[tuple] = []
        size = 0
        for n, window in enumerate(pack(pieces(), capacity)):
            offset = 0
            for p in window:
                rows.append((p.doc_id, p.start, len(p), p.ids, p.doc_tokens, first_id + n, offset, len(p) == p.doc_tokens))
                offset += len(p)
            size += 4 * offset
            if size > BATCH_BYTES:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, SCHEMA)


def with_checksums(pieces: DataFrame) -> DataFrame:
    """Pieces with the CRC-32 of their packed ids in place of the ids."""
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "whole"
    )
