"""Token counts of every prefix of a text, by dynamic programming.

Within a piece that merges never cross, BPE's ids of a prefix are those of a
shorter prefix and one token more: the one token ending there that BPE would
leave beside the last token before it. So count[i] = count[i - len(token)] + 1,
and one pass over a piece gives the exact count at each of its prefixes. A
text's table adds the pieces up; it answers how many tokens a truncated text
has, and where a budget of tokens ends, without encoding anything again.
"""

from __future__ import annotations

from bisect import bisect_right
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airtally.llm import bytebpe
from airtally.llm.common import per_slice

#: Pieces that a worker remembers, and bytes up to which a piece is remembered.
REMEMBERED = 400_000
REMEMBERED_BYTES = 64


class PrefixCounts:
    def __init__(self, path: str):
        self.vocabulary = v = bytebpe.load(path)
        self.pairs = {(a, b): rank for rank, (a, b, _) in enumerate(v.merges)}
        self.rank = {made: rank for rank, (_, _, made) in enumerate(v.merges)}
        self.parts = {made: (a, b) for a, b, made in v.merges}
        self.longest = max(map(len, v.ids))
        # A token that BPE would not make of its own bytes can never be left over.
        self.usable = {data: token for data, token in v.ids.items() if self._built(token)}
        self.met: dict[tuple[int, int], bool] = {}
        self.tables: dict[str, list[int]] = {}
        self.totals: dict[str, int] = {}

    def beside(self, left: int, right: int) -> bool:
        """Whether BPE leaves two tokens side by side.

        It does not if, while both were being built, their inner edges ever were
        a mergeable pair whose turn came before the merge that next covered one
        of them. So both are taken apart again, the latest merge first; of equal
        ranks the right one was made last.
        """
        until = len(self.pairs)  # ranks below this one would have come first
        rank, pairs = self.rank, self.pairs
        own_left = False  # whether `until` is the left token's merge, which then wins at an equal rank
        while True:
            r = pairs.get((left, right))
            if r is not None and (r < until or (r == until and not own_left)):
                return False
            a, b = rank.get(left, -1), rank.get(right, -1)
            if a < 0 and b < 0:
                return True
            if a > b:
                until, own_left, left = a, True, self.parts[left][1]
            else:
                until, own_left, right = b, False, self.parts[right][0]

    def of_bytes(self, data: bytes) -> list[int]:
        """The token count of each prefix of one piece, from the empty one on."""
        usable, met, longest = self.usable, self.met, self.longest
        if len(met) > REMEMBERED:
            met.clear()
        n = len(data)
        count, last = [0] * (n + 1), [-1] * (n + 1)
        for end in range(1, n + 1):
            for start in range(max(0, end - longest), end):
                token = usable.get(data[start:end])
                if token is None:
                    continue
                if start:
                    pair = (last[start], token)
                    fits = met.get(pair)
                    if fits is None:
                        fits = met[pair] = self.beside(*pair)
                    if not fits:
                        continue
                count[end], last[end] = count[start] + 1, token
                break
        return count

    def _built(self, token: int) -> bool:
        """Whether BPE makes this token of its own bytes."""
        symbols = [self.vocabulary.ids[bytes([b])] for b in self.vocabulary.pieces[token]]
        while len(symbols) > 1:
            rank, k = min((self.pairs.get(p, 1 << 60), k) for k, p in enumerate(zip(symbols, symbols[1:], strict=False)))
            if rank == 1 << 60:
                return False
            symbols[k : k + 2] = [self.vocabulary.merges[rank][2]]
        return symbols == [token]

    def of_piece(self, piece: str) -> list[int]:
        table = self.tables.get(piece)
        if table is None:
            table = self.of_bytes(piece.encode())
            if len(table) <= REMEMBERED_BYTES:
                if len(self.tables) > REMEMBERED:
                    self.tables.clear()
                self.tables[piece] = table
        return table

    def of_chunk(self, chunk: str) -> int:
        """Tokens of a whole chunk."""
        if chunk in self.vocabulary.special:
            return 1
        return sum([self.of_piece(p)[-1] for p in bytebpe.PIECE.findall(chunk)])

    def total(self, text: str) -> int:
        totals, chunks = self.totals, self.vocabulary.chunks(text)
        if len(totals) > REMEMBERED:
            totals.clear()
        for chunk in set(chunks).difference(totals):
            totals[chunk] = self.of_chunk(chunk)
        return sum(map(totals.__getitem__, chunks))

    def table(self, text: str) -> np.ndarray:
        """The exact token count of text[:i] for i from 0 to its length.

        Differs from adding up whole pieces where a cut changes the pieces: a
        contraction cut short, white space at the end of the cut text, and a
        special string cut short are each looked at as the cut text has them.
        """
        out = np.zeros(len(text) + 1, dtype=np.int64)
        at = done = 0  # place in the text, tokens before it
        white = 0  # start of the white space that ends at `at`
        before_white = 0  # tokens before that
        for chunk in self.vocabulary.chunks(text):
            if chunk in self.vocabulary.special:
                for k in range(1, len(chunk)):
                    out[at + k] = self.total(text[white : at + k]) + before_white if white < at else done + self.total(chunk[:k])
                at, done = at + len(chunk), done + 1
                out[at] = done
                white, before_white = at, done
                continue
            blank = len(chunk) - len(chunk.lstrip(" ")) if chunk.strip(bytebpe_white()) else len(chunk)
            for k in range(1, blank + 1):  # cut inside white space: all of it up to the cut is one piece
                out[at + k] = before_white + self.of_piece(text[white : at + k])[-1]
            if blank < len(chunk):
                inner = done
                start = 0
                for piece in bytebpe.PIECE.findall(chunk):
                    counts, size = self.of_piece(piece), 0
                    cut_short = piece in bytebpe.CONTRACTIONS
                    for k, char in enumerate(piece, 1):
                        size += len(char.encode())
                        place = start + k
                        if place <= blank:
                            continue
                        if cut_short and k < len(piece):
                            out[at + place] = inner + sum([self.of_piece(p)[-1] for p in bytebpe.PIECE.findall(piece[:k])])
                        else:
                            out[at + place] = inner + counts[size]
                    inner, start = inner + counts[-1], start + len(piece)
                at, done = at + len(chunk), inner
                white, before_white = at, done
            else:
                done += self.of_piece(chunk)[-1]
                at += len(chunk)
        return out

    def within(self, text: str, budget: int) -> int:
        """The length of the longest prefix of at most `budget` tokens, such that no longer one fits."""
        table = self.table(text)
        fits = np.flatnonzero(table <= budget)
        return int(fits[-1]) if len(fits) else 0


def bytebpe_white() -> str:
    """White space as the pieces see it."""
    return _WHITE


_WHITE = "".join(c for c in map(chr, range(0x3001)) if bytebpe.re.match(f"[{bytebpe.WHITE}]", c))


@cache
def counter(path: str) -> PrefixCounts:
    return PrefixCounts(path)


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_bytes (UTF-8) and n_tokens of the whole text.

    A null text counts as empty: 0 and 0. Special strings inside a text count as
    the one token they are. Repeated rows come back as often as they came.
    """

    def make():
        counts = counter(path)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            return pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(t.encode()) for t in texts], pa.int64()),
                    pa.array([counts.total(t) for t in texts], pa.int64()),
                ],
                ["doc_id", "n_bytes", "n_tokens"],
            )

        return step

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return per_slice(rows, make, "doc_id long, n_bytes long, n_tokens long")


def budget_cuts(
    docs: DataFrame, path: str, budgets: list[int], id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row and budget: doc_id, budget, n_chars (of the longest prefix within it), n_tokens (of that prefix).

    All answers of a text come from its one table. Null text: 0 and 0.
    """
    wanted = sorted(set(budgets))

    def make():
        counts = counter(path)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                table = counts.table(text or "")
                lowest = np.minimum.accumulate(table[::-1])[::-1].tolist()  # never falls, so that it can be searched
                for budget in wanted:
                    n = max(0, bisect_right(lowest, budget) - 1)
                    rows.append((key, budget, n, int(table[n])))
            columns = list(zip(*rows, strict=True)) or [[], [], [], []]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], ["doc_id", "budget", "n_chars", "n_tokens"]
            )

        return step

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return per_slice(rows, make, "doc_id long, budget long, n_chars long, n_tokens long", 64)
