"""BPE encoding and decoding by a segment tree over the ranks of adjacent pairs.

A piece's symbols stand side by side; leaf i of the tree holds the rank of
symbol i and its right neighbour, with i below it, so that the root names the
leftmost pair of the lowest rank. A merge changes three leaves and the nodes
above them. Pieces of similar length share one array, a tree to a row, and
their merges advance together; a long piece is a row with a deep tree.
"""

from __future__ import annotations

import hashlib
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airtally.llm import bytebpe
from airtally.llm.common import per_slice

NEVER = np.int64(1) << 62
#: Cells of the arrays of one group of trees.
CELLS = 1 << 21
#: Pieces after which what a worker remembers becomes the older half; what is met again of that half is kept.
REMEMBERED = 350_000
#: Fewer pieces than this of one size are merged one by one, as arrays of few rows cost more than they save.
FEW = 24
#: Rows, and bytes of them, whose new pieces are merged together.
TOGETHER = 4096
TOGETHER_BYTES = 24 << 20


class SegmentTreeBPE:
    """Encodes pieces and whole texts; remembers the pieces it has met, up to a bound."""

    def __init__(self, path: str):
        self.vocabulary = bytebpe.load(path)
        merges = np.array(self.vocabulary.merges, dtype=np.int64)
        codes = merges[:, 0] << 32 | merges[:, 1]
        order = np.argsort(codes, kind="stable")
        self.codes, self.ranks, self.made = codes[order], order, merges[:, 2]
        self.pairs = {code: (rank << 32, made) for rank, (code, made) in enumerate(zip(codes.tolist(), merges[:, 2].tolist(), strict=True))}
        self.single = np.array([self.vocabulary.ids[bytes([b])] for b in range(256)], dtype=np.int64)
        self.known: dict[str, tuple[str, int, bytes]] = {}
        self.older: dict[str, tuple[str, int, bytes]] = {}

    def _leaf(self, left: np.ndarray, right: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The leaf of each pair: its rank, then its place; NEVER where there is no such merge."""
        code = left << 32 | right
        k = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        return np.where((left >= 0) & (right >= 0) & (self.codes[k] == code), self.ranks[k] << 32 | at, NEVER)

    def _merge(self, pieces: list[bytes], size: int) -> list[list[int]]:
        """The ids of pieces of at most `size` bytes, a power of two."""
        n = len(pieces)
        symbol = np.full((n, size + 1), -1, dtype=np.int64)  # the last column stays empty
        for row, piece in enumerate(pieces):
            symbol[row, : len(piece)] = self.single[np.frombuffer(piece, dtype=np.uint8)]
        place = np.arange(size + 1)
        after = np.tile(np.minimum(place + 1, size), (n, 1))
        before = np.tile(np.where(place == 0, size, place - 1), (n, 1))
        tree = np.full((n, 2 * size), NEVER, dtype=np.int64)
        tree[:, size:] = self._leaf(symbol[:, :-1], symbol[:, 1:], place[:-1])
        width = size
        while width > 1:
            width //= 2
            tree[:, width : 2 * width] = np.minimum(tree[:, 2 * width : 4 * width : 2], tree[:, 2 * width + 1 : 4 * width : 2])
        row = np.flatnonzero(tree[:, 1] < NEVER)
        while len(row):
            root = tree[row, 1]
            i = root & 0xFFFFFFFF
            j = after[row, i]
            k = after[row, j]
            symbol[row, i] = self.made[root >> 32]
            symbol[row, j] = -1
            after[row, i] = k
            before[row, k] = i
            h = before[row, i]
            tree[row, size + j] = NEVER
            tree[row, size + i] = self._leaf(symbol[row, i], symbol[row, k], i)
            h = np.where(h == size, i, h)  # nothing to the left: that leaf once more
            left = h != i
            if left.any():
                tree[row[left], size + h[left]] = self._leaf(symbol[row[left], h[left]], symbol[row[left], i[left]], h[left])
            nodes = [size + j, size + i, size + h]
            for _ in range(size.bit_length() - 1):
                for x, node in enumerate(nodes):
                    node = node >> 1
                    tree[row, node] = np.minimum(tree[row, 2 * node], tree[row, 2 * node + 1])
                    nodes[x] = node
            row = row[tree[row, 1] < NEVER]
        return [line[line >= 0].tolist() for line in symbol]

    def _merge_one(self, piece: bytes, size: int) -> list[int]:
        """The same tree in plain lists, for one piece; a change goes up only as far as it changes a node."""
        never, pairs, last = int(NEVER), self.pairs, len(piece) - 1
        symbol = self.single[np.frombuffer(piece, dtype=np.uint8)].tolist()
        after, before = list(range(1, last + 2)), list(range(-1, last))
        tree = [never] * (2 * size)
        for i in range(last):
            pair = pairs.get(symbol[i] << 32 | symbol[i + 1])
            if pair:
                tree[size + i] = pair[0] | i
        for node in range(size - 1, 0, -1):
            a, b = tree[2 * node], tree[2 * node + 1]
            tree[node] = a if a < b else b
        while (root := tree[1]) < never:
            i = root & 0xFFFFFFFF
            j = after[i]
            k = after[j]
            symbol[i] = pairs[symbol[i] << 32 | symbol[j]][1]
            symbol[j] = -1
            after[i] = k
            changed = [(j, never)]
            if k <= last:
                before[k] = i
                pair = pairs.get(symbol[i] << 32 | symbol[k])
                changed.append((i, pair[0] | i if pair else never))
            else:
                changed.append((i, never))
            h = before[i]
            if h >= 0:
                pair = pairs.get(symbol[h] << 32 | symbol[i])
                changed.append((h, pair[0] | h if pair else never))
            for leaf, value in changed:
                node = size + leaf
                tree[node] = value
                node >>= 1
                while node:
                    a, b = tree[2 * node], tree[2 * node + 1]
                    least = a if a < b else b
                    if tree[node] == least:
                        break
                    tree[node] = least
                    node >>= 1
        return [s for s in symbol if s >= 0]

    def encode_pieces(self, pieces: list[str]) -> dict[str, list[int]]:
        """The ids of distinct pieces."""
        groups: dict[int, list[tuple[str, bytes]]] = {}
        for piece in pieces:
            data = piece.encode()
            groups.setdefault(max(2, 1 << (len(data) - 1).bit_length()), []).append((piece, data))
        out = {}
        for size, group in groups.items():
            if len(group) < FEW:
                out.update((piece, self._merge_one(data, size)) for piece, data in group)
                continue
            step = max(1, CELLS // size)
            for at in range(0, len(group), step):
                part = group[at : at + step]
                out.update(zip([p for p, _ in part], self._merge([d for _, d in part], size), strict=True))
        return out

    def _record(self, ids: list[int]) -> tuple[str, int, bytes]:
        return ",".join(map(str, ids)), len(ids), b"".join([self.vocabulary.pieces[i] for i in ids])

    def learn(self, chunks: set[str]) -> None:
        """Put the chunks not met before among the known ones."""
        if len(self.known) > REMEMBERED:
            self.known, self.older = {}, self.known
        known, older, special = self.known, self.older, self.vocabulary.special
        unknown = [c for c in chunks if c not in known]
        known.update((c, older[c]) for c in unknown if c in older)
        split = {c: bytebpe.PIECE.findall(c) for c in unknown if c not in known and c not in special}
        met = {p for pieces in split.values() for p in pieces if p not in known}
        known.update((p, older[p]) for p in met if p in older)
        new = {p for p in met if p not in known}
        ids = self.encode_pieces(list(new))
        for piece, its in ids.items():
            known[piece] = self._record(its)
        for chunk, pieces in split.items():
            if len(pieces) > 1:
                parts = [known[p] for p in pieces]
                known[chunk] = ",".join([p[0] for p in parts]), sum([p[1] for p in parts]), b"".join([p[2] for p in parts])
        for text, i in special.items():
            known[text] = self._record([i])

    def encode(self, text: str) -> list[int]:
        chunks = self.vocabulary.chunks(text)
        self.learn(set(chunks))
        return [int(i) for c in chunks for i in self.known[c][0].split(",")]

    def decode(self, ids: list[int]) -> str:
        """The ids' bytes as text; bytes that are no UTF-8 become replacement characters."""
        return b"".join([self.vocabulary.pieces[i] for i in ids]).decode("utf-8", "replace")


@cache
def coder(path: str) -> SegmentTreeBPE:
    return SegmentTreeBPE(path)


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ids (array of int) and the text decoded from them.

    A null text counts as empty and gives no ids; other columns are not read,
    repeated rows come back as often as they came.
    """

    def make():
        bpe = coder(path)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids = [bpe.encode(t or "") for t in batch.column(1).to_pylist()]
            decoded = [bpe.decode(x) for x in ids]
            return pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array(decoded, pa.string())],
                ["doc_id", "ids", "decoded"],
            )

        return step

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return per_slice(rows, make, "doc_id long, ids array<int>, decoded string", 128)


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_tokens, SHA-256 of the decimal ids joined by commas, SHA-256 of the decoded text.

    As encode_documents, with the ids of each chunk joined as text once and the
    decoded bytes taken from the ids' own table. Null text: no ids, both digests
    of the empty string.
    """

    def make():
        bpe = coder(path)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [bpe.vocabulary.chunks(t) if t else [] for t in batch.column(1).to_pylist()]
            bpe.learn(set().union(*texts))
            known, n, of_ids, of_text = bpe.known, [], [], []
            for chunks in texts:
                parts = [known[c] for c in chunks]
                n.append(sum([p[1] for p in parts]))
                of_ids.append(hashlib.sha256(",".join([p[0] for p in parts]).encode()).hexdigest())
                decoded = b"".join([p[2] for p in parts]).decode("utf-8", "replace")
                of_text.append(hashlib.sha256(decoded.encode()).hexdigest())
            return pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(of_ids), pa.array(of_text)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

        return step

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return per_slice(rows, make, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", TOGETHER, TOGETHER_BYTES)
