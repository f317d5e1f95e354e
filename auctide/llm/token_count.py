"""Token counts by prefix dynamic programming over a word BPE.

For every prefix of a text the operator holds the exact number of tokens of
that prefix, so "how many tokens", "where does the text reach n tokens" and
"cut to a budget" need no second encoding. Inside a word, the last token of a
prefix follows from shorter prefixes: it is the vocabulary entry that ends
there and is stable (see ``merges``) beside the last token of the prefix
before it. Merging never crosses words, so text prefixes add up word counts.

A word-final symbol differs from the same character inside a word, hence two
tables per word: ``inner`` (the word goes on) and ``closed`` (the prefix ends
here).
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auctide.llm.common import small_batches
from auctide.llm.merges import Merges, Recent, trie

#: Words a worker remembers; a full table starts over.
MEMORY = 800_000


class WordBpe:
    """Prefix tables of one ``tokenizers`` file of kind "BPE with word ends"."""

    def __init__(self, path: str):
        import regex
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.end = model["end_of_word_suffix"]
        steps = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        whole = {a + b: (a, b) for a, b in reversed(steps)}
        self.merges = Merges({p: p[0] + p[1] for p in steps},
                             {a + b: i for i, (a, b) in reversed(list(enumerate(steps)))}, whole)
        self.vocab = frozenset(whole) | {t for t in model["vocab"] if len(t) - t.endswith(self.end) * len(self.end) == 1}
        self.longest = max(map(len, self.vocab))
        self.byte = _byte_letters()
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.split = regex.compile(split).findall
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.trie = trie({t: t for t in self.vocab if not t.endswith(self.end)})
        self.words, self.chunks = Recent(MEMORY), Recent(MEMORY)

    # -- one word ---------------------------------------------------------

    def ahead(self, word: str) -> tuple[list, list[int]]:
        """Last token and token count of each prefix of a word of byte letters that goes on."""
        n = len(word)
        last: list = [None] * (n + 1)
        inner = [0] * (n + 1)
        known, stable, root = self.merges.seen, self.merges.stable, self.trie
        for j in range(n):
            node, left, c = root, last[j], inner[j] + 1
            for i in range(j, n):
                node = node.get(word[i])
                if node is None:
                    break
                t = node.get("")
                if t is not None and not inner[i + 1]:
                    if j:
                        free = known.get((left, t))
                        if free is None:
                            free = stable(left, t)
                        if not free:
                            continue
                    last[i + 1], inner[i + 1] = t, c
        return last, inner

    def closing(self, word: str, n: int, last: list, inner: list[int]) -> int:
        """Tokens of the first ``n`` letters as a closed word, from the tables of the open one."""
        stable, vocab, longest = self.merges.stable, self.vocab, self.longest
        for j in range(max(0, n - longest), n):
            t = word[j:n] + self.end
            if t in vocab and (j == 0 or stable(last[j], t)):
                return inner[j] + 1
        raise AssertionError("every byte letter closes a word")

    def tables(self, word: str) -> tuple[list[int], list[int]]:
        """Tokens of each prefix of a word of byte letters: as a closed word, and as one that goes on."""
        last, inner = self.ahead(word)
        return [0] + [self.closing(word, n, last, inner) for n in range(1, len(word) + 1)], inner

    def word(self, word: str) -> int:
        """Tokens of a whole word of byte letters."""
        got = self.words.get(word)
        if got is None:
            got = self.closing(word, len(word), *self.ahead(word[:-1]))
            self.words.put(word, got)
        return got

    # -- texts ------------------------------------------------------------

    def normal(self, text: str) -> str:
        if text.isascii():
            return text.lower()
        text = unicodedata.normalize("NFC", text)
        return "".join(map(str.lower, text))  # character by character: no context rule for a final sigma

    def letters(self, word: str) -> str:
        if word.isascii() and word.isprintable():
            return word
        byte = self.byte
        return "".join([byte[b] for b in word.encode()])

    def chunk(self, raw: bytes) -> int:
        """Tokens of a run without ASCII white space; words and special strings never span such space."""
        text = raw.decode("utf-8", "replace")
        count, parts = 0, [text]
        if self.special and "<" in text:
            parts = self.special.split(text)
            count = len(parts) - 1
        letters, word = self.letters, self.word
        for p in parts:
            for w in self.split(self.normal(p)):
                count += word(letters(w))
        return count

    def per_chunk(self, text: str) -> list[int]:
        seen, known = self.chunks.young.get, self.known
        return [seen(raw) or known(raw) for raw in text.encode("utf-8", "replace").split()]

    def known(self, raw: bytes) -> int:
        n = self.chunks.get(raw)
        if n is None:
            n = self.chunk(raw)
            self.chunks.put(raw, n)
        return n

    def count(self, text: str | None) -> int:
        return sum(self.per_chunk(text)) if text else 0

    def prefix_counts(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text and the token count of each of its prefixes, the empty one first.

        Special strings are normalised like any other text here, so the counts
        are those of an encoder that takes them as ordinary text.
        """
        import regex
        text = regex.sub(r"\s+", " ", self.normal(text))
        counts = np.zeros(len(text) + 1, np.int64)
        done = at = 0
        for w in self.split(text):
            start = text.index(w, at)
            counts[at:start + 1] = done
            # prefixes that cut a word are split anew: "'re" cut to "'r" is two words
            if w.startswith("'") and len(w) > 1:
                for k in range(1, len(w) + 1):
                    counts[start + k] = done + sum(self.word(self.letters(x)) for x in self.split(w[:k]))
            else:
                closed, _ = self.tables(self.letters(w))
                ends = np.cumsum([len(c.encode()) for c in w])
                counts[start + 1:start + len(w) + 1] = done + np.array(closed)[ends]
            at = start + len(w)
            done = int(counts[at])
        counts[at:] = done
        return text, counts


def _byte_letters() -> list[str]:
    """The printable letter that byte-level vocabularies use for each byte."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, extra = [""] * 256, 0
    for b in range(256):
        if b in own:
            out[b] = chr(b)
        else:
            out[b], extra = chr(256 + extra), extra + 1
    return out


@lru_cache(maxsize=2)
def word_bpe(path: str) -> WordBpe:
    return WordBpe(path)


def count_tokens(docs: DataFrame, path: str, limit: int = 2048) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit``: one row per input row.

    Whole texts without begin, end or padding; special strings inside a text
    count as the library's default takes them, one token each. A null text
    counts as empty (0 bytes, 0 tokens). Null ids and repeated rows stay as
    they are, other columns are ignored, an empty table gives no rows.
    ``path`` must exist on every executor (a tokenizer file of the platform).
    """
    small_batches(docs.sparkSession)

    @F.pandas_udf("long")
    def tokens(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bpe = word_bpe(path)
        for s in texts:
            yield pd.Series([bpe.count(t) for t in s], dtype="int64")

    return (docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
                        tokens("text").alias("n_tokens"))
            .withColumn("over_limit", F.col("n_tokens") > limit))


def cut_to_budget(docs: DataFrame, path: str, budget: int) -> DataFrame:
    """``doc_id, n_chars, n_tokens, text``: the longest prefix of the normalised text within ``budget``.

    Answered from the prefix table: the last position whose count is at most
    ``budget``. Null texts give an empty prefix.
    """
    small_batches(docs.sparkSession)

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = word_bpe(path)
        for f in frames:
            rows = []
            for i, t in zip(f["doc_id"], f["text"]):
                text, counts = bpe.prefix_counts(t or "")
                k = int(np.flatnonzero(counts <= budget)[-1])
                rows.append((i, k, int(counts[k]), text[:k]))
            yield pd.DataFrame(rows, columns=["doc_id", "n_chars", "n_tokens", "text"])

    return docs.select("doc_id", "text").mapInPandas(cut, "doc_id long, n_chars long, n_tokens long, text string")
