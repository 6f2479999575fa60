"""Bounded-space online packing of token documents into sequences of fixed length.

Each task keeps a fixed number of open windows. A document's ids go whole into
the window that they fill best. When none has room, the fullest one takes the
document's first ids up to its brim and is emitted; a brim of a few ids is left
as padding instead, as pieces that short are of no use. Ids beyond a whole
sequence are cut off first, as sequences of their own. At its end a task pours
its open windows together; what is less than one sequence is merged with that
of other tasks, some hundreds of tasks at a time, until one remainder is left.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airtally.llm.common import sliced, stored

#: Tasks whose remainders are merged by one task of the next round.
MERGED = 256
#: Words that a worker remembers the ids of, and characters of the longest one; tasks to come keep them too.
REMEMBERED = 1 << 19
REMEMBERED_LENGTH = 64
#: New words that the library gets as one text, and what stands between them.
JOINED = 256
MARK = "\x01"
#: Rows, and bytes of them, of a slice; more than elsewhere, as a slice's distinct words are looked up once each.
SLICE = 2048
SLICE_BYTES = 8 << 20
#: Words that are letters, all in Latin-1, and signs after them; how a tokenizer is set that parts the two and lower-cases.
LETTERS_AND_SIGNS = r"^(?P<letters>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<signs>[!-/:-@\[-`{-~]*)$"
LOWER = {
    "type": "Sequence",
    "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}],
}
BY_KIND = {
    "type": "Sequence",
    "pretokenizers": [
        {
            "type": "Split",
            "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
            "behavior": "Removed",
            "invert": True,
        },
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
ROWS = PIECES + ", part long, ids binary"  # ids: of pieces that still have to be merged


class WordTokenizer:
    """Ids of texts whose tokenizer drops white space, as little-endian unsigned 32-bit numbers.

    No token crosses white space, so the ids of a text are those of its words,
    which the library gives. A slice's distinct words are looked up once each;
    new ones are given to the library many in a text, with a mark between them.
    Where the tokenizer takes letters apart from what follows them and lower-cases
    them, a word like `And,` is looked up as `and` and `,`. When many words are
    remembered, they become the older ones, of which those stay that are met again.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {"": b""}
        self.older: dict[str, bytes] = {}
        self.mark = np.frombuffer(self._each([MARK])[0], "<u4")
        whole = json.loads(self.tokenizer.to_str())
        own = [whole["normalizer"], whole["pre_tokenizer"], [t["content"] for t in whole["added_tokens"] if re.search(LETTERS_AND_SIGNS, t["content"])]]
        self.apart = own == [LOWER, BY_KIND, []]

    def _each(self, words: list[str]) -> list[bytes]:
        encoded = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in encoded]

    def _joined(self, words: list[str]) -> list[bytes]:
        """Ids of words that are given as one text; one by one where the mark's id does not stand just between them."""
        text = f" {MARK} ".join(words)
        if len(self.mark) != 1 or text.count(MARK) != len(words) - 1:
            return self._each(words)
        ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")
        marks = np.flatnonzero(ids == self.mark[0])
        if len(marks) != len(words) - 1:
            return self._each(words)
        data, ends = ids.tobytes(), (4 * marks).tolist()
        return [data[start:end] for start, end in zip([0, *(end + 4 for end in ends)], [*ends, len(data)], strict=True)]

    def learn(self, words: list[str]) -> list[bytes]:
        """The ids of distinct words."""
        if len(self.known) > REMEMBERED // 2:
            self.known, self.older = {"": b""}, self.known
        ids = list(map(self.known.get, words))
        new = []
        for k, x in enumerate(ids):
            if x is None:
                old = self.older.get(words[k])
                if old is None:
                    new.append(k)
                else:
                    ids[k] = self.known[words[k]] = old
        for at in range(0, len(new), JOINED):
            part = new[at : at + JOINED]
            for k, x in zip(part, self._joined([words[k] for k in part]), strict=True):
                ids[k] = x
                if len(words[k]) <= REMEMBERED_LENGTH:
                    self.known[words[k]] = x
        return ids

    def _lists(self, words: pa.Array) -> pa.LargeListArray:
        """The ids of each of some distinct words."""
        if self.apart:
            found = pc.extract_regex(words, LETTERS_AND_SIGNS)
            letters = pc.coalesce(pc.utf8_lower(pc.struct_field(found, "letters")), words)
            signs = pc.fill_null(pc.struct_field(found, "signs"), "")
            both = pa.concat_arrays([letters, signs]).dictionary_encode()
        else:
            both = words.dictionary_encode()
        ids = self.learn(both.dictionary.to_pylist())
        ends = np.concatenate([[0], np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)))]) // 4
        lists = pa.LargeListArray.from_arrays(pa.array(ends), np.frombuffer(b"".join(ids), "<u4"))
        if not self.apart:
            return lists.take(both.indices)
        lists = lists.take(pa.array(both.indices.to_numpy().reshape(2, -1).T.ravel()))
        return pa.LargeListArray.from_arrays(pa.array(_starts(lists)[::2]), lists.flatten())

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        words = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        every = words.flatten().dictionary_encode()
        taken = self._lists(every.dictionary).take(every.indices)
        data = memoryview(taken.flatten().to_numpy()).cast("B")
        at = (4 * _starts(taken)[_starts(words)]).tolist()
        return [bytes(data[start:end]) for start, end in zip(at[:-1], at[1:], strict=True)]


def _starts(lists: pa.Array) -> np.ndarray:
    """Where each list starts among the entries of all, and the last one ends."""
    return np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(), dtype=np.int64)])


@cache
def word_tokenizer(path: str) -> WordTokenizer:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    return WordTokenizer(path)


class Piece:
    """A run of one document's ids; four bytes to an id."""

    __slots__ = ("doc_id", "doc_tokens", "ids", "start")

    def __init__(self, doc_id: int | None, start: int, ids: bytes, doc_tokens: int):
        self.doc_id, self.start, self.ids, self.doc_tokens = doc_id, start, ids, doc_tokens

    def __len__(self) -> int:
        return len(self.ids) // 4

    def cut(self, at: int) -> tuple[Piece, Piece]:
        head = Piece(self.doc_id, self.start, self.ids[: 4 * at], self.doc_tokens)
        return head, Piece(self.doc_id, self.start + at, self.ids[4 * at :], self.doc_tokens)


class Packer:
    """The open windows of one task. place() and close() give the sequences that are done, as lists of pieces."""

    def __init__(self, length: int, windows: int, least: int):
        self.length, self.windows, self.least = length, windows, least
        self.open: list[list[Piece]] = []
        self.room: list[int] = []

    def place(self, piece: Piece) -> Iterator[list[Piece]]:
        while len(piece) >= self.length:
            head, piece = piece.cut(self.length)
            yield [head]
        while len(piece):
            n = len(piece)
            fits = [(room, k) for k, room in enumerate(self.room) if room >= n]
            if fits:
                room, k = min(fits)
                self.open[k].append(piece)
                self.room[k] = room - n
                if room == n:
                    yield self._take(k)
                return
            if len(self.open) < self.windows:
                self.open.append([piece])
                self.room.append(self.length - n)
                return
            room, k = min((room, k) for k, room in enumerate(self.room))
            if room >= self.least:
                head, piece = piece.cut(room)
                self.open[k].append(head)
            yield self._take(k)

    def _take(self, k: int) -> list[Piece]:
        self.room.pop(k)
        return self.open.pop(k)

    def close(self) -> Iterator[list[Piece]]:
        """Pour the open windows together, the fullest first; the last sequence may be short."""
        order = sorted(range(len(self.open)), key=lambda k: (self.room[k], k))
        yield from poured([p for k in order for p in self.open[k]], self.length)
        self.open, self.room = [], []


def poured(pieces: list[Piece], length: int) -> Iterator[list[Piece]]:
    """Full sequences of the pieces in their order, then what is left."""
    now: list[Piece] = []
    room = length
    for piece in pieces:
        while len(piece) >= room:
            head, piece = piece.cut(room)
            yield [*now, head]
            now, room = [], length
        if len(piece):
            now.append(piece)
            room -= len(piece)
    if now:
        yield now


class Rows:
    """Pieces of sequences as columns of an Arrow batch."""

    def __init__(self, level: int, group: int):
        self.level, self.group, self.sequences = level, group, 0
        self.columns: list[list] = [[] for _ in range(9)]

    def add(self, sequence: list[Piece], remainder: bool = False) -> None:
        number = (self.level << 56) + (self.group << 24) + self.sequences
        self.sequences += 1
        offset = 0
        for p in sequence:
            n = len(p)
            row = (p.doc_id, p.start, n, zlib.crc32(p.ids), p.doc_tokens, number, offset)
            row += (self.group, p.ids) if remainder else (None, None)
            for column, value in zip(self.columns, row, strict=True):
                column.append(value)
            offset += n

    def batch(self) -> pa.RecordBatch:
        kinds = [pa.int64()] * 8 + [pa.binary()]
        names = [x.split(" ")[0] for x in ROWS.split(", ")]
        out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(self.columns, kinds, strict=True)], names)
        self.columns = [[] for _ in range(9)]
        return out


def pack(
    docs: DataFrame,
    path: str,
    end_id: int,
    length: int = 4096,
    windows: int = 64,
    least: int = 32,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Each document's ids end with end_id. A null or empty text is that id alone.
    Repeated rows are documents of their own; a null id stays null. Only the two
    named columns are read. An empty table gives no rows.

    One step is written to the shared folder: the pieces, and the ids of each
    task's remainder, which is less than one sequence.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, end = word_tokenizer(path), end_id.to_bytes(4, "little")
        packer, out = Packer(length, windows, least), Rows(0, TaskContext.get().partitionId())
        for part in sliced(batches, SLICE, SLICE_BYTES):
            texts = part.column(1).fill_null("")
            for key, ids in zip(part.column(0).to_pylist(), tokenizer.encode(texts), strict=True):
                ids += end
                for sequence in packer.place(Piece(key, 0, ids, len(ids) // 4)):
                    out.add(sequence)
            if out.columns[0]:
                yield out.batch()
        for sequence in packer.close():
            out.add(sequence, remainder=sum(map(len, sequence)) < length)
        if out.columns[0]:
            yield out.batch()

    step = stored(rows.mapInArrow(run, ROWS), "packed")
    done = step.where(F.col("part").isNull()).select(PIECES_NAMES)
    left, level = step.where(F.col("part").isNotNull()), 0
    tasks = left.agg(F.max("part")).first()[0]
    while tasks is not None:
        level, tasks = level + 1, tasks // MERGED
        merged = stored(_merge(left, length, level, last=tasks == 0), f"merged-{level}")
        done = done.unionByName(merged.where(F.col("part").isNull()).select(PIECES_NAMES))
        left = merged.where(F.col("part").isNotNull())
        if tasks == 0:
            break
    return done


PIECES_NAMES = [x.split(" ")[0] for x in PIECES.split(", ")]


def _merge(left: DataFrame, length: int, level: int, last: bool) -> DataFrame:
    """The remainders of MERGED neighbouring tasks poured together, less than one sequence each."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        group = key[0].as_py()
        rows = table.sort_by([("part", "ascending"), ("offset", "ascending")]).to_pylist()
        pieces = [Piece(r["doc_id"], r["start"], r["ids"], r["doc_tokens"]) for r in rows]
        out = Rows(level, group)
        for sequence in poured(pieces, length):
            out.add(sequence, remainder=not last and sum(map(len, sequence)) < length)
        return pa.Table.from_batches([out.batch()])

    return left.groupBy(F.floor(F.col("part") / MERGED).alias("group")).applyInArrow(run, ROWS)
