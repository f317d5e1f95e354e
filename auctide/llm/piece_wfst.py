"""SentencePiece encoding and decoding as a weighted finite-state transducer.

Three machines are compiled from the model file: the normaliser (the model
here has the identity rule: a space becomes the mark U+2581, one mark is put
in front), the pieces, and byte fallback for characters without a piece.
An input composed with them is a lattice of positions whose arcs are pieces.
The model is a merge (BPE) model, so a path is the encoding exactly if all
neighbouring pieces are stable under merging; the composition therefore keeps
the last piece in its state and gives an arc tropical weight 0 after a stable
pair and infinity after any other. The tropical shortest path is the one path
of finite weight; it is found by one forward pass.

No piece contains certain neighbouring characters (for one, a letter before
the mark), so the lattice falls apart there and is solved per segment;
segments are remembered by each worker, within a bound.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auctide.llm.common import small_batches
from auctide.llm.merges import Merges, Recent, trie

MARK = "▁"
#: Segments (and as many parts of segments) and pairs of pieces that a worker remembers.
MEMORY, PAIRS = 400_000, 400_000
#: Tropical semiring: weights add along a path, the smaller total wins.
ZERO, ONE = float("inf"), 0.0


class PieceTransducer:
    """Encoder and decoder of one SentencePiece BPE model."""

    def __init__(self, path: str):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.vocab_size()
        self.names = [model.id_to_piece(i) for i in range(n)]
        self.bytes = {}
        plain = {}
        for i, p in enumerate(self.names):
            if model.is_byte(i):
                self.bytes[int(p[3:5], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                plain[p] = i
        self.ids = plain
        self.rank = {p: -model.get_score(i) for p, i in plain.items()}
        self.longest = max(map(len, plain))
        inner = {p[k:k + 2] for p in plain for k in range(len(p) - 1)}
        self.inner = frozenset(inner)
        self.letters = frozenset(p for p in plain if len(p) == 1)
        self.merges = Merges(_Joins(plain), self.rank, _Parts(self))
        self.arcs = _arc_trie(plain)
        self.size = [len(p) for p in self.names]
        self.parts = Recent(MEMORY)
        self.known: dict[int, bool] = {}
        self.segments = Recent(MEMORY)
        self.out = [self._surface(i) for i in range(n)]

    # -- arcs -----------------------------------------------------------------

    def weight(self, left: str | None, right: str) -> float:
        """Tropical weight of the arc ``right`` in a state whose last piece is ``left``."""
        if left is None:
            return ONE if self.whole(right) else ZERO
        if MARK * 2 in left or MARK * 2 in right:  # runs of marks share one rank: merge to see
            return ONE if self.apart(left, right) else ZERO
        return ONE if self.merges.stable(left, right) else ZERO

    @lru_cache(maxsize=40_000)  # noqa: B019  (one transducer per worker)
    def apart(self, left: str, right: str) -> bool:
        return self.merge(left + right) == [left, right]

    def merge(self, s: str) -> list[str]:
        """Pieces of a short string by merging, best rank first, then leftmost."""
        parts, rank = list(s), self.rank
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: (rank.get(parts[i] + parts[i + 1], ZERO), i))
            if rank.get(parts[best] + parts[best + 1], ZERO) == ZERO:
                break
            parts[best:best + 2] = [parts[best] + parts[best + 1]]
        return parts

    def fallback(self, char: str) -> list[int]:
        return [self.bytes[b] for b in char.encode("utf-8", "replace")]

    # -- shortest path ----------------------------------------------------------

    def path(self, s: str) -> list[int]:
        """Ids on the shortest path through the lattice of one segment.

        All finite paths weigh the same, and a position is reached by one
        finite path at most, so the search goes depth first, longest piece
        first, and visits a position once. A character without a piece is a
        segment of its own and takes its bytes.
        """
        n = len(s)
        if n == 1:
            return [self.ids[s]] if s in self.ids else self.fallback(s)
        root, longest, known, size = self.arcs, self.longest, self.known, self.size
        path: list[int] = []
        rest: list[tuple] = []  # arcs not yet tried at each position of the path
        at, left, tries = 0, -1, None
        while at < n:
            if tries is None:
                node = root
                for c in s[at:at + longest]:
                    down = node.get(c)
                    if down is None:
                        break
                    node = down
                arcs = node[""]
                tries = len(arcs)
            while tries:
                tries -= 1
                right = arcs[tries]
                key = left << 16 | right
                free = known.get(key)
                if free is None:
                    if len(known) >= PAIRS:
                        known.clear()
                    free = known[key] = self.weight(self.names[left] if path else None, self.names[right]) == ONE
                if free:
                    path.append(right)
                    rest.append((arcs, tries))
                    at, left, tries = at + size[right], right, None
                    break
            else:
                at -= size[path.pop()]
                left = path[-1] if path else -1
                arcs, tries = rest.pop()
        return path

    @lru_cache(maxsize=40_000)  # noqa: B019  (one transducer per worker)
    def whole(self, piece: str) -> bool:
        """Whether merging makes this piece from its characters."""
        return self.merge(piece) == [piece]

    def cut(self, s: str) -> list[str]:
        """Segments between runs of letters and of others whose border no piece contains.

        A segment with a character that has no piece is cut at every such
        border, which sets that character apart.
        """
        inner, out = self.inner, []
        for run in _RUNS(s):
            if out and out[-1][-1] + run[0] in inner:
                out[-1] += run
            else:
                out.append(run)
        if self.letters.issuperset(s):
            return out
        return [x for part in out for x in ([part] if self.letters.issuperset(part) else self._cut_all(part))]

    def _cut_all(self, s: str) -> list[str]:
        inner, out, at = self.inner, [], 0
        for k in range(1, len(s)):
            if s[k - 1:k + 1] not in inner:
                out.append(s[at:k])
                at = k
        out.append(s[at:])
        return out

    def segment(self, raw: str) -> bytes:
        """Packed ids of the mark and a run without spaces."""
        got = self.segments.get(raw)
        if got is None:
            seen, part = self.parts.young.get, self.part
            got = b"".join([seen(p) or part(p) for p in self.cut(MARK + raw)])
            self.segments.put(raw, got)
        return got

    def part(self, s: str) -> bytes:
        got = self.parts.get(s)
        if got is None:
            got = array("H", self.path(s)).tobytes()
            self.parts.put(s, got)
        return got

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of a text, ``uint16``; none for null or empty."""
        if not text:
            return np.zeros(0, np.uint16)
        if MARK in text:
            text = text.replace(MARK, " ")
        if "  " in text or text[0] == " " or text[-1] == " ":
            return np.frombuffer(b"".join(self._with_runs(text)), np.uint16)
        seen, segment = self.segments.young.get, self.segment
        return np.frombuffer(b"".join([seen(w) or segment(w) for w in text.split(" ")]), np.uint16)

    def _with_runs(self, text: str) -> Iterator[bytes]:
        """Runs of marks take part in merges with the word behind them, so they stay together."""
        words = (" " + text).split(" ")
        marks = 0
        for w in words[1:]:
            if w:
                if marks:
                    yield self._run(marks + 1, w)
                else:
                    yield self.segment(w)
                marks = 0
            else:
                marks += 1
        if marks:
            yield self._run(marks, "")

    def _run(self, marks: int, word: str) -> bytes:
        ids = [i for part in self.cut(MARK * marks + word) for i in self.path(part)]
        return array("H", ids).tobytes()

    # -- decoding -----------------------------------------------------------------

    def _surface(self, i: int) -> bytes:
        name = self.names[i]
        if name in self.ids and self.ids[name] == i:
            return name.replace(MARK, " ").encode()
        for b, j in self.bytes.items():
            if i == j:
                return bytes([b])
        return b""

    def decode(self, ids) -> str:
        """Text of ids: the inverse transducer; broken byte sequences become U+FFFD."""
        out = b"".join(map(self.out.__getitem__, ids.tolist() if hasattr(ids, "tolist") else ids))
        return (out[1:] if out[:1] == b" " else out).decode("utf-8", "replace")


def _arc_trie(ids: dict) -> dict:
    """Trie of the pieces; a node holds the ids of all pieces on its way, shortest first."""
    root = trie(ids)
    todo = [(root, ())]
    while todo:
        node, above = todo.pop()
        above = above + ((node[""],) if "" in node else ())
        todo += [(down, above) for c, down in node.items() if c]
        node[""] = above
    return root


class _Joins:
    """Merge table of a model whose merges are named by their result."""

    def __init__(self, ids: dict):
        self.ids = ids

    def get(self, pair: tuple):
        s = pair[0] + pair[1]
        return s if s in self.ids else None


class _Parts:
    """Last merge of each piece, found on demand: the stable pair of shorter pieces that gives it."""

    def __init__(self, machine: PieceTransducer):
        self.machine, self.known = machine, {}

    def get(self, piece: str):
        if len(piece) == 1:
            return None
        got = self.known.get(piece)
        if got is None:
            got = self.known[piece] = self._find(piece)
        return got

    def _find(self, piece: str):
        rank, whole, parts = self.machine.rank, self.machine.rank[piece], list(piece)
        while len(parts) > 2:
            best = min(range(len(parts) - 1), key=lambda i: (rank.get(parts[i] + parts[i + 1], ZERO), i))
            if rank.get(parts[best] + parts[best + 1], ZERO) >= whole:
                break
            parts[best:best + 2] = [parts[best] + parts[best + 1]]
        return (parts[0], "".join(parts[1:]))


_RUNS = re.compile(r"[^\W\d_]+|[\W\d_]+").findall


@lru_cache(maxsize=2)
def transducer(path: str) -> PieceTransducer:
    return PieceTransducer(path)


ENCODED = "ids array<int>, n_pieces long, decoded_sha256 string, round_trip boolean"


def encode(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids, n_pieces, decoded_sha256, round_trip``: one row per input row.

    ``ids`` are the library's ids of the whole text, ``decoded_sha256`` the
    digest of the text decoded from them (lower-case hex), ``round_trip``
    whether that is the text itself (it is not where the text holds U+2581,
    which the model writes for a space). A null or empty text has no ids and
    round-trips as the empty text. Null ids and repeated rows stay as they are;
    other columns are ignored; an empty table gives no rows. ``path`` must
    exist on every executor.
    """
    small_batches(docs.sparkSession)

    @F.pandas_udf(ENCODED)
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        machine = transducer(path)
        for s in texts:
            ids, digest, same = [], [], []
            for t in s:
                t = t or ""
                x = machine.encode(t)
                back = machine.decode(x)
                ids.append(x.astype(np.int32))
                digest.append(hashlib.sha256(back.encode()).hexdigest())
                same.append(back == t)
            yield pd.DataFrame({"ids": ids, "n_pieces": [len(x) for x in ids], "decoded_sha256": digest,
                                "round_trip": same})

    return docs.select("doc_id", run("text").alias("e")).select("doc_id", "e.*")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded (doc_id, ids)`` back to ``doc_id, text``; null ids give an empty text."""
    small_batches(encoded.sparkSession)

    @F.pandas_udf("string")
    def run(lists: Iterator[pd.Series]) -> Iterator[pd.Series]:
        machine = transducer(path)
        for s in lists:
            yield pd.Series([machine.decode(x) if x is not None else "" for x in s])

    return encoded.select("doc_id", run("ids").alias("text"))
