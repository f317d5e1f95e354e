"""Language of words and texts by a linear-chain conditional random field.

Words (runs of letters) are labelled jointly: affix and n-gram features
(hashed two- and three-byte runs of the word between border marks), a lexicon
feature (counts of frequent words per language over all training documents)
and learned transitions; forward-backward gives each word's distribution, so
code-switched text gets a label per word. A text's language is the label with
the largest mean probability over its words, and that mean is its score.

Lexicon counts cover every training document; each language keeps its own most
frequent words. Weights are fitted on a bounded sample per language (all of a
language with fewer texts), cut into windows of which half join two languages,
so the transitions learn that text may switch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auctide.llm.common import crc_mod, small_batches, stored
from auctide.llm.crf import Adagrad, batch_marginals, chain_marginals

#: Bounds of the model and of its fit, shared equally by the languages: texts, their spans, lexicon words.
FIT_DOCS, FIT_SPANS, LEXICON, BUCKETS = 1500, 30_000, 20_000, 1 << 15
#: Least share of a language.
LEAST_DOCS, LEAST_SPANS, LEAST_WORDS = 50, 1000, 500
#: Longest run labelled as one word (bytes); longer ones are labelled in pieces of this size.
PIECE = 24
SPAN = 32
MEMORY = 200_000
UNDEFINED = "und"
_LETTERS = bytes(c if c >= 0x80 or chr(c).isalpha() else 0x20 for c in range(256))


def words_of(text: str) -> list[bytes]:
    out = text.lower().encode("utf-8", "replace").translate(_LETTERS).split()
    if max(map(len, out), default=0) <= PIECE:
        return out
    return [w[i:i + PIECE] for w in out for i in range(0, len(w), PIECE)]


def feature_ids(words: list[bytes]) -> np.ndarray:
    """Hashed bigrams and trigrams of ``^word$``; BUCKETS where a word is shorter."""
    a = np.array([b"^" + w + b"$" for w in words], f"S{PIECE + 2}").view(np.uint8).reshape(len(words), -1)
    width = max(1, int((a != 0).any(axis=0).sum()))
    a = a[:, :max(3, width)].astype(np.uint32)
    two = (a[:, :-1] * 2654435761 + a[:, 1:] * 40503) >> 7
    tri = (a[:, :-2] * 2246822519 + a[:, 1:-1] * 3266489917 + a[:, 2:] * 668265263) >> 9
    return np.concatenate([np.where(a[:, 1:] > 0, two % BUCKETS, BUCKETS),
                           np.where(a[:, 2:] > 0, tri % BUCKETS, BUCKETS)], axis=1).astype(np.int64)


@dataclass
class Model:
    languages: list
    weights: np.ndarray      # (BUCKETS + 1, K), the last row stays 0
    lexicon: dict            # word -> row of lexicon_scores
    lexicon_scores: np.ndarray
    lexicon_weight: np.ndarray
    trans: np.ndarray
    start: np.ndarray

    def scores(self, words: list[bytes]) -> np.ndarray:
        ids = feature_ids(words)
        s = np.zeros((len(words), len(self.languages)))
        for c in range(ids.shape[1]):
            s += self.weights[ids[:, c]]
        return s + self.lexical(words) * self.lexicon_weight

    def lexical(self, words: list[bytes]) -> np.ndarray:
        none = len(self.lexicon_scores) - 1
        return self.lexicon_scores[[self.lexicon.get(w, none) for w in words]]


class Labeller:
    """Marginals of the words of many texts; remembers the scores of words it has met."""

    def __init__(self, model: Model):
        self.model, self.rows = model, {}
        self.table = np.zeros((0, len(model.languages)))

    def emissions(self, words: list[bytes]) -> np.ndarray:
        rows = self.rows
        if len(rows) > MEMORY:
            rows.clear()
            self.table = self.table[:0]
        new = [w for w in dict.fromkeys(words) if w not in rows]
        if new:
            for i in range(0, len(new), 20_000):
                part = new[i:i + 20_000]
                s = self.model.scores(part)
                e = np.exp(s - s.max(axis=1, keepdims=True)) + 1e-9
                rows.update(zip(part, range(len(self.table), len(self.table) + len(part))))
                self.table = np.concatenate([self.table, e])
        return self.table[[rows[w] for w in words]]

    def label(self, texts: list[str]) -> list[np.ndarray]:
        lists = [words_of(t) for t in texts]
        sizes = np.array([len(x) for x in lists])
        first = np.zeros(sizes.sum(), bool)
        first[np.cumsum(sizes)[:-1][sizes[1:] > 0]] = True if len(sizes) > 1 else False
        if len(first):
            first[0] = True
        m = self.model
        post = chain_marginals(self.emissions([w for x in lists for w in x]), first,
                               np.exp(m.trans), np.exp(m.start))
        return np.split(post, np.cumsum(sizes)[:-1])

    def texts(self, texts: list) -> tuple[list[str], list[float]]:
        """Language and score of each text; UNDEFINED and 0 for null or no letter."""
        names, scores = [UNDEFINED] * len(texts), [0.0] * len(texts)
        have = [i for i, t in enumerate(texts) if t and any(map(str.isalpha, t))]
        group, size = [], 0
        for i in [*have, None]:
            if i is None or size > 1_500_000:
                if group:
                    for j, p in zip(group, self.label([texts[j] for j in group])):
                        mean = p.mean(axis=0)
                        k = int(mean.argmax())
                        names[j], scores[j] = self.model.languages[k], float(min(1.0, mean[k]))
                group, size = [], 0
            if i is not None:
                group.append(i)
                size += len(texts[i])
        return names, scores


def lexicon_counts(train: DataFrame, quota: int) -> DataFrame:
    """``word, n, counts (map lang -> n)`` of about ``quota`` most frequent words of every language, over all rows."""
    small_batches(train.sparkSession)

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from collections import Counter
        sums: dict = {}
        held = 0
        for f in frames:
            for t, lang in zip(f["text"], f["lang"]):
                c = sums.setdefault(lang, Counter())
                held -= len(c)
                c.update(words_of(t or ""))
                held += len(c)
            if held > MEMORY:  # hand over partial sums; Spark adds them up
                yield _partial(sums)
                sums, held = {}, 0
        yield _partial(sums)

    parts = train.select("text", "lang").mapInPandas(count, "lang string, word string, n long")
    per = parts.groupBy("word", "lang").agg(F.sum("n").alias("n"))
    per = stored(per, "lang-words")
    step = F.floor(F.log2("n") * 16)
    hist = per.groupBy("lang", step.alias("step")).agg(F.count("*").alias("rows")).collect()
    cuts = []
    for lang in {r.lang for r in hist}:
        above, cut = 0, (-1, 1.0)  # the step that is taken in part, and the part
        for r in sorted((r for r in hist if r.lang == lang), key=lambda r: -r.step):
            if above + r.rows > quota:
                cut = (r.step, (quota - above) / r.rows)
                break
            above += r.rows
        cuts.append((lang, *cut))
    cuts = train.sparkSession.createDataFrame(cuts, "lang string, cut long, share double")
    edge = F.pmod(F.xxhash64("word"), F.lit(1 << 30)) < F.col("share") * (1 << 30)
    return (per.join(F.broadcast(cuts), "lang")
            .withColumn("top", (step > F.col("cut")) | ((step == F.col("cut")) & edge))
            .groupBy("word").agg(F.sum("n").alias("n"), F.max("top").alias("top"), F.map_from_entries(
                F.collect_list(F.struct("lang", "n"))).alias("counts")).filter("top").drop("top"))


def _thinned(rows: DataFrame, totals: dict, quota: int, *by: str) -> DataFrame:
    """About 1.2 ``quota`` rows of every language by a hash of ``by``; all of one with no more."""
    edges = [(lang, min(1 << 30, int(1.2 * quota / max(1, n) * (1 << 30)) + 1)) for lang, n in totals.items()]
    edges = rows.sparkSession.createDataFrame(edges, "lang string, edge long")
    return (rows.join(F.broadcast(edges), "lang")
            .filter(F.pmod(F.xxhash64(F.lit("sample"), *by), F.lit(1 << 30)) < F.col("edge")).drop("edge"))


def sample_spans(train: DataFrame, totals: dict) -> DataFrame:
    """``lang, words``: spans of a bounded number of different texts of every language in ``totals``.

    Copies of a text count once. Texts of any length are cut into spans in the
    tasks; what is kept of them is chosen by hash, from their whole length.
    """
    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for lang, key, text in zip(f["lang"], f["key"], f["text"]):
                w = words_of(text)
                rows = [(lang, key, i, b" ".join(w[i:i + SPAN])) for i in range(0, len(w), SPAN)]
                yield pd.DataFrame(rows, columns=["lang", "key", "no", "words"])

    texts = train.select("lang", "text", F.xxhash64("text").alias("key"))
    texts = (_thinned(texts, totals, max(LEAST_DOCS, FIT_DOCS // len(totals)), "key")
             .groupBy("lang", "key").agg(F.first("text").alias("text")))
    spans = stored(texts.select("lang", "key", "text").mapInPandas(
        cut, "lang string, key long, no long, words binary"), "lang-spans")
    number = {r.lang: r["count"] for r in spans.groupBy("lang").count().collect()}
    return _thinned(spans, number, max(LEAST_SPANS, FIT_SPANS // len(totals)), "key", "no").orderBy("lang", "key", "no")


def _partial(sums: dict) -> pd.DataFrame:
    rows = [(lang, w.decode("utf-8", "replace"), n) for lang, c in sums.items() for w, n in c.items()]
    return pd.DataFrame(rows, columns=["lang", "word", "n"])


def fit_from(docs: DataFrame, held_out) -> Model | None:
    """Model from the rows of ``docs (doc_id, text, lang)`` outside ``held_out``; None without any."""
    train = docs.filter(~held_out & F.col("lang").isNotNull() & F.col("text").isNotNull())
    totals = {r.lang: r.n for r in train.groupBy("lang").agg(
        F.approx_count_distinct(F.xxhash64("text"), 0.02).alias("n")).collect()}
    languages = sorted(totals)
    if not languages:
        return None
    at = {x: i for i, x in enumerate(languages)}
    lex = sorted(lexicon_counts(train, max(LEAST_WORDS, LEXICON // len(languages))).collect(),
                 key=lambda r: (-r.n, r.word))
    sample = sample_spans(train, totals).collect()
    return fit([(bytes(r.words), at[r.lang]) for r in sample], languages,
               [(r.word.encode(), [r.counts.get(x, 0) for x in languages]) for r in lex])


def fit(sample: list, languages: list, lexicon: list, rounds: int = 2) -> Model:
    """Model from ``sample`` of (text, or its words joined by spaces as bytes; number of the language)."""
    k = len(languages)
    counts = np.array([c for _, c in lexicon], float).reshape(-1, k)
    total = counts.sum(axis=0, keepdims=True) + 1
    share = (counts + 0.5 * total / total.max()) / total  # an unseen word has the same share in a rare language
    lex = np.log(share / share.mean(axis=1, keepdims=True)).clip(-4, 4) if len(counts) else share
    model = Model(languages, np.zeros((BUCKETS + 1, k)), {w: i for i, (w, _) in enumerate(lexicon)},
                  np.concatenate([lex.reshape(-1, k), np.zeros((1, k))]), np.full(k, 0.3),
                  np.eye(k) * 2.0, np.zeros(k))
    rng = np.random.default_rng(9)
    spans = []
    for text, lang in sample:
        w = words_of(text) if isinstance(text, str) else text.split()
        spans += [(w[i:i + SPAN], lang) for i in range(0, len(w), SPAN)]
    opt = Adagrad(0.1)
    for _ in range(rounds):
        order = rng.permutation(len(spans))
        for i in range(0, len(order), 256):
            batch = []
            for j in order[i:i + 256]:
                w, y = spans[j]
                if rng.random() < 0.5:  # code-switched: the rest of the window comes from another text
                    cut = int(rng.integers(1, SPAN))
                    w2, y2 = spans[int(rng.integers(len(spans)))]
                    batch.append((w[:cut] + w2[cut:], [y] * len(w[:cut]) + [y2] * len(w2[cut:])))
                else:
                    batch.append((w, [y] * len(w)))
            batch = [b for b in batch if b[0]]
            flat = [w for ws, _ in batch for w in ws]
            if not flat:
                continue
            ids, lexical = feature_ids(flat), model.lexical(flat)
            s = lexical * model.lexicon_weight
            for c in range(ids.shape[1]):
                s += model.weights[ids[:, c]]
            lens = np.array([len(b[0]) for b in batch])
            live = np.arange(lens.max())[None, :] < lens[:, None]
            padded, gold = np.zeros((*live.shape, k)), np.zeros((*live.shape, k))
            padded[live] = s
            y = np.concatenate([b[1] for b in batch])
            gold[live] = np.eye(k)[y]
            u, pairs, first = batch_marginals(padded, lens, model.trans, model.start)
            g = (gold - u)[live]
            seen = np.zeros((k, k))
            for b in batch:
                np.add.at(seen, (b[1][:-1], b[1][1:]), 1)
            n = len(flat)
            wide = np.stack([np.bincount(ids.ravel(), np.repeat(g[:, c], ids.shape[1]), BUCKETS + 1)
                             for c in range(k)], axis=1) / n
            wide[BUCKETS] = 0
            opt.step("w", model.weights, wide)
            opt.step("x", model.lexicon_weight, (g * lexical).sum(axis=0) / n - 1e-4 * model.lexicon_weight)
            opt.step("t", model.trans, (seen - pairs) / n - 1e-3 * model.trans)
            opt.step("s", model.start, (gold[:, 0].sum(axis=0) - first) / len(batch) - 1e-3 * model.start)
    return model


def identify(docs: DataFrame, folds: int = 3, hold: int = 1) -> DataFrame:
    """``doc_id, held_out, lang_pred, score``: one row per input row.

    Learns from text and non-null lang of the rows whose crc32(doc_id) modulo
    ``folds`` is not ``hold``; predictions use text only. A null text or one
    without a letter is ``und`` with score 0, and so is every text when there
    is nothing to learn from. Null ids fall into remainder 0; repeated rows get
    equal predictions; other columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text", "lang")
    held = crc_mod("doc_id", folds) == hold
    model = fit_from(docs, held)
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)  # fixed size: BUCKETS and LEXICON rows

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = shared.value
        labeller = Labeller(m) if m else None
        for s in texts:
            names, scores = labeller.texts(list(s)) if m else ([UNDEFINED] * len(s), [0.0] * len(s))
            yield pd.DataFrame({"lang_pred": names, "score": scores})

    return (docs.select("doc_id", held.alias("held_out"), predict("text").alias("p"))
            .select("doc_id", "held_out", "p.lang_pred", "p.score"))
