"""Byte-level BPE encoding and decoding by dynamic programming over prefixes.

Merging is never simulated. The vocabulary is compiled into a suffix automaton:
read byte by byte, its state stands for the longest end of the bytes read that
lies inside some token, and its suffix links lead through all tokens that end
at this byte. A prefix of a word has exactly one last token: the token that
ends there and is compatible with the last token of the prefix before it, that
is, merging the two texts together leaves the border alone (``merges``). So
every prefix stores one token, found by asking the candidates of the automaton
from the longest to the shortest, and the ids of the word are read off
backwards, each token pointing to the prefix it follows.

Merging never crosses pre-tokens. Cuts are made at a space before a character
that is no white space, always the start of a pre-token. A worker takes the
distinct runs between such cuts of a batch of texts, and the distinct pre-tokens
of the runs it does not remember go through the same dynamic programming side by
side, prefix by prefix, in numpy arrays; a prefix that several of them share is
worked out once. Memories are bounded.
"""

from __future__ import annotations

import json
import re
import struct
from collections import deque
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auctide.llm.common import small_batches
from auctide.llm.merges import Merges

#: Runs, and pre-tokens, that a worker remembers, and the most characters one may have.
RUNS, WORDS, LONGEST = 500_000, 500_000, 48
#: Pairs of neighbouring tokens that a worker remembers; pre-tokens that go side by side.
PAIRS, SIDE_BY_SIDE = 1 << 20, 1 << 15
#: Fewer new pre-tokens than this are done one by one.
FEW = 48


class SuffixAutomaton:
    """All factors of named byte strings; knows which of the strings end at the last byte read."""

    def __init__(self, strings: dict[bytes, int]):
        self.step: dict[int, int] = {}  # state << 8 | byte -> state
        self.link, self.length = [-1], [0]
        self._copies: list[list[int]] = [[]]  # bytes on which a state has a step
        self._grow(strings)
        del self._copies
        found: list[list[tuple[int, int]]] = [[] for _ in self.link]
        for s, name in strings.items():
            state = 0
            for b in s:
                state = self.step[state << 8 | b]
            found[state].append((len(s), name))
        # the strings of a state, longest first, and then those of the next state up that has some
        order = sorted(range(len(self.link)), key=self.length.__getitem__)
        self.ends: list[tuple] = [()] * len(order)
        for state in order:
            above = self.ends[self.link[state]] if state else ()
            own = tuple(sorted(found[state], reverse=True))
            self.ends[state] = own + above if own else above

    def _grow(self, strings: Iterable[bytes]) -> None:
        """Breadth first over the tree of the strings, so that shorter factors come first."""
        tree: dict[int, int] = {}
        children: list[list[tuple[int, int]]] = [[]]
        for s in strings:
            node = 0
            for b in s:
                down = tree.get(node << 8 | b)
                if down is None:
                    down = tree[node << 8 | b] = len(children)
                    children.append([])
                    children[node].append((b, down))
                node = down
        todo = deque([(0, 0)])
        while todo:
            node, state = todo.popleft()
            for b, child in children[node]:
                todo.append((child, self._extend(state, b)))

    def _new(self, length: int) -> int:
        self.link.append(0)
        self.length.append(length)
        self._copies.append([])
        return len(self.link) - 1

    def _set(self, state: int, b: int, to: int) -> None:
        key = state << 8 | b
        if key not in self.step:
            self._copies[state].append(b)
        self.step[key] = to

    def _extend(self, state: int, b: int) -> int:
        step, link, length = self.step, self.link, self.length
        there = step.get(state << 8 | b)
        if there is not None:
            return there if length[there] == length[state] + 1 else self._split(state, b, there)
        new = self._new(length[state] + 1)
        p = state
        while p >= 0 and (p << 8 | b) not in step:
            self._set(p, b, new)
            p = link[p]
        if p >= 0:
            q = step[p << 8 | b]
            link[new] = q if length[q] == length[p] + 1 else self._split(p, b, q)
        return new

    def _split(self, p: int, b: int, q: int) -> int:
        """The factors of ``q`` that are reached through ``p`` get a state of their own."""
        step, link, length = self.step, self.link, self.length
        part = self._new(length[p] + 1)
        for c in self._copies[q]:
            self._set(part, c, step[q << 8 | c])
        link[part], link[q] = link[q], part
        while p >= 0 and step.get(p << 8 | b) == q:
            step[p << 8 | b] = part
            p = link[p]
        return part


class IntTable:
    """A fixed map from non-negative 64-bit keys to 32-bit values, looked up for whole arrays (open addressing)."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, int(np.ceil(np.log2(max(1, len(keys))))) + 2)
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int32)
        keys, values = keys.astype(np.int64), values.astype(np.int32)
        slot = self._slot(keys)
        while len(keys):
            # of the keys that meet at a free slot the first takes it, the others go on
            first = np.zeros(len(keys), bool)
            first[np.unique(slot, return_index=True)[1]] = True
            put = first & (self.keys[slot] < 0)
            self.keys[slot[put]], self.values[slot[put]] = keys[put], values[put]
            keys, values, slot = keys[~put], values[~put], (slot[~put] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The values of ``keys``, -1 for those that are not there."""
        slot = self._slot(keys)
        there = self.keys[slot]
        out = np.where(there == keys, self.values[slot], -1)
        open_ = np.flatnonzero((there != keys) & (there >= 0))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & self.mask
            there = self.keys[slot[open_]]
            hit = there == keys[open_]
            out[open_[hit]] = self.values[slot[open_[hit]]]
            open_ = open_[~hit & (there >= 0)]
        return out


class SideBySide:
    """The dynamic programming of many pre-tokens at once: a row per byte, a column per pre-token."""

    def __init__(self, automaton: SuffixAutomaton, merges: Merges, size: int):
        step = automaton.step
        self.step = IntTable(np.fromiter(step.keys(), np.int64, len(step)), np.fromiter(step.values(), np.int64, len(step)))
        self.link, self.longest = np.array(automaton.link, np.int32), np.array(automaton.length, np.int32)
        # candidates of all states behind one another
        counts = np.array([len(e) for e in automaton.ends])
        self.first = np.concatenate([[0], np.cumsum(counts)[:-1]])
        flat = np.array([x for e in automaton.ends for x in e], np.int32).reshape(-1, 2)
        self.lengths, self.tokens = flat[:, 0].copy(), flat[:, 1].copy()
        self.size = np.zeros(size, np.int32)
        self.size[self.tokens] = self.lengths
        self.rank = np.full(size, -1.0)
        self.left, self.right = np.full(size, -1, np.int32), np.full(size, -1, np.int32)
        for t, (l, r) in merges.parts.items():
            self.rank[t], self.left[t], self.right[t] = merges.rank[t], l, r
        pairs = np.array([(l << 32 | r, t) for (l, r), t in merges.join.items()], np.int64).reshape(-1, 2)
        self.join = IntTable(pairs[:, 0], pairs[:, 1])
        self.seen_pair, self.seen_apart = np.full(PAIRS, -1, np.int64), np.zeros(PAIRS, bool)

    def words(self, words: list[bytes]) -> Iterator[bytes]:
        """Packed ids of each pre-token; ``words`` come in order, so that neighbours share prefixes."""
        for at in range(0, len(words), SIDE_BY_SIDE):
            yield from self._columns(words[at:at + SIDE_BY_SIDE])

    def _columns(self, words: list[bytes]) -> Iterator[bytes]:
        sizes = np.array([len(w) for w in words])
        deep, m = int(sizes.max()), len(words)
        raw = np.frombuffer(b"".join([w.ljust(deep, b"\0") for w in words]), np.uint8).reshape(m, deep)
        # a prefix is worked out where it first occurs: bytes that a word shares with the one before it
        differs = raw[1:] != raw[:-1]
        shared = np.where(differs.any(axis=1), differs.argmax(axis=1), deep)
        shared = np.concatenate([[0], np.minimum(shared, np.minimum(sizes[1:], sizes[:-1]))])
        last = np.zeros((deep + 1, m), np.int32)
        state, matched = np.zeros(m, np.int32), np.zeros(m, np.int32)
        for i in range(1, deep + 1):
            rows = np.flatnonzero(sizes >= i)
            fresh = shared[rows] < i
            first = rows[fresh]
            s, k = state[first], matched[first]
            self._read(raw[first, i - 1].astype(np.int64), s, k)
            t = self._choose(i, s, k, last, first)
            of = np.cumsum(fresh) - 1
            state[rows], matched[rows], last[i, rows] = s[of], k[of], t[of]
        # the way back, one token of every pre-token at a time
        steps, at, columns = [], sizes.copy(), np.arange(m)
        while at.any():
            t = np.where(at > 0, last[at, columns], -1)
            steps.append(t)
            at = np.where(at > 0, at - self.size[t], 0)
        tokens = np.array(steps[::-1], "<i4").T
        used = tokens >= 0
        flat, ends = tokens[used].tobytes(), 4 * np.cumsum(used.sum(axis=1))
        start = 0
        for end in ends.tolist():
            yield flat[start:end]
            start = end

    def _read(self, byte: np.ndarray, state: np.ndarray, matched: np.ndarray) -> None:
        """One step of the automaton in every column, in place."""
        to = self.step.find(state.astype(np.int64) << 8 | byte)
        lost = np.flatnonzero(to < 0)
        while len(lost):
            state[lost] = self.link[state[lost]]
            matched[lost] = self.longest[state[lost]]
            to[lost] = self.step.find(state[lost].astype(np.int64) << 8 | byte[lost])
            lost = lost[to[lost] < 0]
        state[:] = to
        matched += 1

    def _choose(self, i: int, state: np.ndarray, matched: np.ndarray, last: np.ndarray,
                columns: np.ndarray) -> np.ndarray:
        """The last token of the prefixes of ``i`` bytes: the first candidate that is compatible."""
        out = np.zeros(len(state), np.int32)
        todo = np.arange(len(state))
        at = self.first[state]
        while len(todo):
            length, t = self.lengths[at], self.tokens[at]
            fits = length <= matched[todo]
            before = np.where(fits, i - length, 0)
            ask = np.flatnonzero(before > 0)
            fits[ask] = self._apart(last[before[ask], columns[todo[ask]]], t[ask])
            out[todo[fits]] = t[fits]
            todo, at = todo[~fits], at[~fits] + 1
        return out

    def _apart(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        pair = left.astype(np.int64) << 32 | right
        slot = (pair * 0x9E3779B1 >> 7) % PAIRS
        out = self.seen_apart[slot]
        new = np.flatnonzero(self.seen_pair[slot] != pair)
        if len(new):
            out[new] = found = self._stable(left[new], right[new])
            self.seen_pair[slot[new]], self.seen_apart[slot[new]] = -1, False
            # of pairs that share a slot one is remembered, with its own answer
            keep = np.unique(slot[new], return_index=True)[1]
            self.seen_pair[slot[new[keep]]], self.seen_apart[slot[new[keep]]] = pair[new[keep]], found[keep]
        return out

    def _stable(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """``Merges.fresh`` of many pairs: undo merges along the border and look for an earlier one across."""
        out = np.zeros(len(left), bool)
        todo, before = np.arange(len(left)), np.full(len(left), np.inf)
        while len(todo):
            across = self.join.find(left.astype(np.int64) << 32 | right)
            goes_on = (across < 0) | (self.rank[across] >= before)
            l, r = self.rank[left], self.rank[right]
            done = goes_on & (l < 0) & (r < 0)
            out[todo[done]] = True
            on = np.flatnonzero(goes_on & ~done)
            todo, left, right, l, r = todo[on], left[on], right[on], l[on], r[on]
            undo_left = (r < 0) | (l > r)
            before = np.where(undo_left, l, r + 0.5)
            left, right = np.where(undo_left, self.right[left], left), np.where(undo_left, right, self.left[right])
        return out


class _Recent:
    """Packed ids of recent strings, none longer than ``LONGEST``: two generations of a bounded number."""

    def __init__(self, size: int):
        self.size, self.young, self.old = size // 2, {}, {}

    def find(self, keys: Iterable[str]) -> dict[str, bytes]:
        young, old = self.young.get, self.old.get
        found = {k: ids for k in keys if (ids := young(k) or old(k)) is not None}
        self.put(found)
        return found

    def put(self, found: dict[str, bytes]) -> None:
        if len(self.young) + len(found) > self.size:
            self.old, self.young = self.young, {}
        self.young.update({k: ids for k, ids in found.items() if len(k) <= LONGEST})


class ByteBpe:
    """Encoder and decoder of one byte-level BPE file of the ``tokenizers`` library."""

    def __init__(self, path: str):
        import regex
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, before = spec["model"], spec["pre_tokenizer"] or {}
        if (model["type"], before.get("type"), before.get("use_regex"), before.get("add_prefix_space")) != (
                "BPE", "ByteLevel", True, False) or spec["normalizer"] or model.get("ignore_merges") \
                or model.get("dropout"):
            raise ValueError("a byte-level BPE file without normaliser and prefix space is needed")
        byte_of = _bytes_by_letter()
        vocab = model["vocab"]
        size = 1 + max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])])
        self.surface: list[bytes] = [b""] * size
        for t, i in vocab.items():
            self.surface[i] = bytes(byte_of[c] for c in t)
        steps = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        join: dict[tuple[int, int], int] = {}
        rank: dict[int, int] = {}
        parts: dict[int, tuple[int, int]] = {}
        for i, (a, b) in enumerate(steps):
            t = vocab[a + b]
            join[vocab[a], vocab[b]] = t
            if t in rank:
                raise ValueError("two merges make one token")
            rank[t], parts[t] = i, (vocab[a], vocab[b])
        self.merges = Merges(join, rank, parts)
        usable = {i for i in vocab.values() if i not in rank and len(self.surface[i]) == 1}
        for t in sorted(rank, key=rank.__getitem__):
            if usable.issuperset(parts[t]) and self.merges.reached(t):
                usable.add(t)
        self.whole = {self.surface[i]: i for i in usable}
        self.automaton = SuffixAutomaton(self.whole)
        self.side_by_side = SideBySide(self.automaton, self.merges, size)
        self.special = {}
        for t in spec["added_tokens"]:
            if t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]:
                raise ValueError("added tokens with stripping or normalising are not supported")
            self.special[t["content"]] = t["id"]
            self.surface[t["id"]] = t["content"].encode()
        longest_first = sorted(self.special, key=len, reverse=True)
        self.cut_special = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")").split
        space = r"\p{White_Space}"
        self.words = regex.compile(rf"'(?:s|t|re|ve|m|ll|d)| ?\p{{L}}+| ?\p{{N}}+| ?[^{space}\p{{L}}\p{{N}}]+"
                                   rf"|{space}+(?!\P{{White_Space}})|{space}+").findall
        self.runs, self.cache = _Recent(RUNS), _Recent(WORDS)

    def word(self, s: bytes) -> list[int]:
        """Ids of one pre-token: the last token of every prefix, then the way back."""
        auto, stable = self.automaton, self.merges.stable
        step, link, longest, ends = auto.step, auto.link, auto.length, auto.ends
        n, state, matched = len(s), 0, 0
        last, size = [-1] * (n + 1), [0] * (n + 1)
        for i, b in enumerate(s, 1):
            to = step.get(state << 8 | b)
            while to is None:
                state = link[state]
                matched = longest[state]
                to = step.get(state << 8 | b)
            state = to
            matched += 1
            for length, t in ends[state]:
                j = i - length
                if length <= matched and (not j or stable(last[j], t)):
                    last[i], size[i] = t, length
                    break
        out = []
        while n:
            out.append(last[n])
            n -= size[n]
        out.reverse()
        return out

    def _packed(self, words: set[str]) -> dict[str, bytes]:
        """Ids of pre-tokens: remembered ones, whole tokens, very long ones by themselves, the rest side by side."""
        out = self.cache.find(words)
        raw = {w.encode(): w for w in words if w not in out}
        new = {raw[r]: _pack([self.whole[r]]) for r in raw if r in self.whole}
        rest = sorted(r for r in raw if r not in self.whole)
        few = len(rest) < FEW
        for r in rest:
            if few or len(r) > 4 * LONGEST:
                new[raw[r]] = _pack(self.word(r))
        rest = [] if few else [r for r in rest if len(r) <= 4 * LONGEST]
        new.update(zip([raw[r] for r in rest], self.side_by_side.words(rest)))
        self.cache.put(new)
        return out | new

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """Packed ids (32 bits each) of each text; a null text has none."""
        plans, heads, wanted = [], {}, set()
        for text in texts:
            plan: list = []  # packed special ids, and lists of runs
            if text:
                special = any(s in text for s in self.special)
                for k, part in enumerate(self.cut_special(text) if special else [text]):
                    if k % 2:
                        plan.append(_pack([self.special[part]]))
                    elif part:
                        runs = _CUT(part) if _ODD_SPACE(part) else part.split(" ")
                        plan.append(runs)
                        if runs[0] not in heads:
                            heads[runs[0]] = self.words(runs[0])
                        wanted.update(runs[1:])
            plans.append(plan)
        # ids of every distinct run of the batch
        ids_of = self.runs.find(wanted)
        alone, marked, mixed = {}, {}, {}
        for run in wanted:
            if run not in ids_of:
                plain = _PLAIN(run)
                if plain is None:
                    mixed[run] = self.words(" " + run)
                elif plain[2]:
                    marked[run] = " " + plain[1]
                else:
                    alone[run] = " " + run
        known = self._packed({*alone.values(), *marked.values(), *MARKS,
                              *chain.from_iterable(chain(mixed.values(), heads.values()))})
        new = {run: known[w] for run, w in alone.items()}
        new |= {run: known[w] + known[run[-1]] for run, w in marked.items()}
        new |= {run: b"".join([known[w] for w in ws]) for run, ws in mixed.items()}
        self.runs.put(new)
        ids_of |= new
        out = []
        for plan in plans:
            parts = []
            for part in plan:
                if isinstance(part, bytes):
                    parts.append(part)
                else:
                    parts += [known[w] for w in heads[part[0]]]
                    parts += [ids_of[run] for run in part[1:]]
            out.append(b"".join(parts))
        return out

    def encode(self, text: str | None) -> list[int]:
        return np.frombuffer(self.encode_all([text])[0], "<i4").tolist()

    def decode(self, ids) -> str:
        surface = self.surface
        return b"".join([surface[i] for i in ids]).decode("utf-8", "replace")


#: A space before white space or the end, where ``str.split`` at spaces would cut inside a run of white space.
_ODD_SPACE = re.compile(r" (?:\s|\Z)").search
_CUT = re.compile(r" (?=\S)").split
#: Latin letters, then at most one mark: two pre-tokens at most, whatever the version of the character tables.
MARKS = ".,;:!?"
_PLAIN = re.compile(rf"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u017f]+)([{MARKS}]?)\Z").match


def _pack(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}i", *ids)


def _bytes_by_letter() -> dict[str, int]:
    """The byte behind each letter of a byte-level vocabulary."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


@lru_cache(maxsize=2)
def byte_bpe(path: str) -> ByteBpe:
    return ByteBpe(path)


def token_ids(path: str, text: Column) -> Column:
    """``array<int>``: ids of whole texts; a null text counts as empty."""
    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = byte_bpe(path)
        for texts in batches:
            ids = bpe.encode_all(texts.to_pylist())
            ends = np.cumsum([0, *map(len, ids)], dtype=np.int64) // 4
            yield pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)),
                                           pa.array(np.frombuffer(b"".join(ids), "<i4")))
    return encode(text)


def text_of(path: str, ids: Column) -> Column:
    """The text behind ``array<int>`` ids, special tokens included; bytes that are no UTF-8 become U+FFFD."""
    @F.arrow_udf("string")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = byte_bpe(path)
        for lists in batches:
            yield pa.array([bpe.decode(x) if x is not None else None for x in lists.to_pylist()], pa.string())
    return decode(ids)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids``: one row per input row, the ids of its whole text.

    A null text counts as empty (no ids); special strings inside a text are one
    token each, as the library takes them; nothing is added, cut or padded.
    Null ids and repeated rows stay as they are, other columns are ignored, an
    empty table gives no rows. ``path`` must exist on every executor.
    """
    small_batches(docs.sparkSession)
    return docs.select("doc_id", token_ids(path, F.col("text")).alias("ids"))


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids, text``: the rows of ``encode`` with the text that their ids spell."""
    small_batches(encoded.sparkSession)
    return encoded.select("doc_id", "ids", text_of(path, F.col("ids")).alias("text"))


def digests(decoded: DataFrame) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of the rows of ``decode``."""
    return decoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))
