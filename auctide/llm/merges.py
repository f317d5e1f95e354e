"""Which neighbouring tokens byte-pair merging leaves apart.

A merge table turns pairs of symbols into longer symbols in order of rank. A
segmentation of a text is the one that merging produces exactly if every
neighbouring pair of tokens is stable: merging the two tokens' text alone
gives the same two tokens back. ``stable`` decides this from the table by
undoing merges along the border, latest rank first, and looking for a merge
across the border that would have come earlier. So the search for a text's
tokens becomes a path search over a lattice with a local licence per pair.
"""

from __future__ import annotations


class Merges:
    """``join[(a, b)]`` gives the merged token; ``rank[t]`` its order; ``parts[t]`` its last merge.

    Symbols that no merge makes have no parts. Equal ranks go left to right.
    """

    def __init__(self, join: dict, rank: dict, parts: dict, memory: int = 400_000):
        self.join, self.rank, self.parts = join, rank, parts
        self.seen: dict = {}
        self.memory = memory

    def stable(self, left, right) -> bool:
        key = (left, right)
        got = self.seen.get(key)
        if got is None:
            if len(self.seen) >= self.memory:
                self.seen.clear()
            got = self.seen[key] = self._stable(left, right)
        return got

    def fresh(self, left, right) -> bool:
        """``stable`` without the memory, for callers that keep their own."""
        return self._stable(left, right)

    def reached(self, token) -> bool:
        """Whether merging a token's own text ends with the token; its parts are taken to be reached."""
        return token not in self.parts or self._stable(*self.parts[token], self.rank[token])

    def _stable(self, left, right, before: float = float("inf")) -> bool:
        """``before``: a crossing merge below this rank would have come first."""
        join, rank, parts = self.join, self.rank, self.parts
        while True:
            crossing = join.get((left, right))
            if crossing is not None and rank[crossing] < before:
                return False
            l, r = parts.get(left), parts.get(right)
            if l is None and r is None:
                return True
            # undo the later of the two merges; of equal ranks the left one came first
            if r is None or (l is not None and rank[left] > rank[right]):
                before, left = rank[left], l[1]
            else:
                before, right = rank[right] + 0.5, r[0]


def trie(entries: dict) -> dict:
    """Nested dicts by character; the value of an entry stands under the empty string."""
    root: dict = {}
    for name, value in entries.items():
        node = root
        for c in name:
            node = node.setdefault(c, {})
        node[""] = value
    return root


class Recent:
    """A bounded memory of two generations: what was not asked for since the last turn is forgotten."""

    def __init__(self, size: int):
        self.size, self.young, self.old = size // 2, {}, {}

    def get(self, key):
        got = self.young.get(key)
        if got is None:
            got = self.old.get(key)
            if got is not None:
                self.put(key, got)
        return got

    def put(self, key, value) -> None:
        if len(self.young) >= self.size:
            self.old, self.young = self.young, {}
        self.young[key] = value
