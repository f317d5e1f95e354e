"""Quality rules by line sequence labelling.

A conditional random field marks every line of a text as content or
boilerplate (Viterbi); the share of words in content lines decides whether the
document stays. The field is fitted here on a bounded sample of labelled
documents: lines of good documents are content, and in bad documents the lines
that a first model separates from good ones are boilerplate (at least one per
document); then transitions and features are trained together. The retention
threshold is the largest at which all but ``LOSS`` of the good documents stay,
read off the content shares of all good labelled documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auctide.llm.common import bounded_sample, small_batches, stored
from auctide.llm.crf import Adagrad, batch_marginals, viterbi

SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
#: Bounds of the fit: labelled documents, and characters of one of them.
FIT_DOCS, FIT_CHARS = 3000, 20_000
#: Good labelled documents that the threshold may lose.
LOSS = 0.002
#: Fixed limits of the base rule: words at least, percent of repeated words at most.
MIN_WORDS, MAX_REPEAT = 20, 30
WINDOW = 8
CONTENT, BOILERPLATE = 0, 1
N_FEATURES = 11
_MIX = np.random.default_rng(8).integers(1, 2**63 - 1, WINDOW, dtype=np.uint64) | np.uint64(1)


def repeat_words(words: list) -> int:
    """Words inside 8-word windows that occur at least twice in the text."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    names: dict = {}
    ids = np.array([names.setdefault(w, len(names)) for w in words], np.int64)
    if len(names) == len(words):
        return 0
    u = ids.view(np.uint64)
    h = np.zeros(n, np.uint64)
    for k in range(WINDOW):
        h += (u[k:k + n] + np.uint64(1)) * _MIX[k]
    order = np.argsort(h, kind="stable")
    same = np.flatnonzero(h[order][1:] == h[order][:-1])
    if not len(same):
        return 0
    win = np.lib.stride_tricks.sliding_window_view(ids, WINDOW)
    a, b = order[same], order[same + 1]
    equal = np.zeros(len(same), bool)
    for i in range(0, len(same), 1 << 16):
        equal[i:i + (1 << 16)] = (win[a[i:i + (1 << 16)]] == win[b[i:i + (1 << 16)]]).all(axis=1)
    edge = np.zeros(len(words) + 1, np.int64)
    hit = np.unique(np.concatenate([a[equal], b[equal]]))
    edge[hit] += 1
    np.add.at(edge, hit + WINDOW, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a whole text."""
    words = text.encode("utf-8", "replace").split()
    seen: set = set()
    dup = 0
    for line in text.split("\n"):
        if line in seen:
            dup += bool(line.strip(SPACE))
        else:
            seen.add(line)
    return (len(words), len(text) - sum(map(text.count, SPACE)), sum(map(text.count, SYMBOLS)), dup,
            repeat_words(words))


def line_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Features ``(lines, N_FEATURES)`` in 0..1 and word counts of the lines that have a word."""
    rows, sizes, seen = [], [], set()
    for line in text.split("\n"):
        words = line.split()
        n = len(words)
        if not n:
            continue
        chars = len(line)
        symbols = sum(map(line.count, "#*$%&<>"))
        rows.append((
            1.0, min(1.0, symbols / n), min(1.0, line.count("|") / n), min(1.0, line.count("!") / n),
            sum(map(str.isupper, words)) / n,
            sum(map(str.__eq__, words, words[1:])) / n,
            1 - len(set(words)) / n if n > 5 else 0.0,
            float(line in seen), float(n < 4), min(1.0, chars / n / 30),
            sum(map(str.isdigit, words)) / n))
        sizes.append(n)
        seen.add(line)
    return np.array(rows).reshape(-1, N_FEATURES), np.array(sizes, np.int64)


class LineField:
    """Weights of the line field; ``share`` is the content share of a text, 1 for one without words."""

    def __init__(self):
        self.w = np.zeros((N_FEATURES, 2))
        self.trans, self.start = np.zeros((2, 2)), np.zeros(2)

    def share(self, text: str) -> float:
        x, sizes = line_features(text)
        if not len(sizes):
            return 1.0
        labels = viterbi(x @ self.w, self.trans, self.start)
        return float(sizes[labels == CONTENT].sum() / sizes.sum())


def _separate(x: np.ndarray, y: np.ndarray, rounds: int = 300) -> np.ndarray:
    """Logistic regression, both classes of equal weight."""
    w, opt = np.zeros(x.shape[1]), Adagrad(0.3)
    weight = np.where(y > 0, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum()))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-(x @ w)))
        opt.step("w", w, x.T @ (weight * (y - p)) - 1e-4 * w)
    return w


def fit(texts: list[str], good: list[int]) -> LineField:
    """Fit on labelled texts (1 good, 0 bad). With one class only, everything counts as content."""
    field = LineField()
    docs = [(line_features(t)[0], g) for t, g in zip(texts, good)]
    docs = [(x, g) for x, g in docs if len(x)]
    if len({g for _, g in docs}) < 2:
        return field
    x = np.concatenate([d for d, _ in docs])
    of = np.repeat(np.arange(len(docs)), [len(d) for d, _ in docs])
    bad = np.array([1 - g for _, g in docs])[of].astype(float)
    y = bad.copy()
    for _ in range(4):  # lines of bad documents that look like lines of good ones become content
        w = _separate(x, y)
        z = x @ w
        top = np.full(len(docs), -np.inf)
        np.maximum.at(top, of, z)
        y = bad * ((z > 0) | (z >= top[of]))
    labels = np.split(y.astype(int), np.cumsum([len(d) for d, _ in docs])[:-1])
    order = sorted(range(len(docs)), key=lambda i: len(docs[i][0]))
    opt = Adagrad(0.2)
    for _ in range(30):
        for i in range(0, len(order), 128):
            part = order[i:i + 128]
            lens = np.array([len(docs[j][0]) for j in part])
            xs, ys = np.zeros((len(part), lens.max(), N_FEATURES)), np.zeros((len(part), lens.max(), 2))
            pairs, first = np.zeros((2, 2)), np.zeros(2)
            for r, j in enumerate(part):
                xs[r, :lens[r]] = docs[j][0]
                ys[r, np.arange(lens[r]), labels[j]] = 1
                np.add.at(pairs, (labels[j][:-1], labels[j][1:]), 1)
                first[labels[j][0]] += 1
            u, p, s = batch_marginals(xs @ field.w, lens, field.trans, field.start)
            n = lens.sum()
            opt.step("w", field.w, np.einsum("btf,btk->fk", xs, ys - u) / n - 1e-4 * field.w)
            opt.step("t", field.trans, (pairs - p) / n - 1e-3 * field.trans)
            opt.step("s", field.start, (first - s) / len(part) - 1e-3 * field.start)
    return field


def _known(labels: DataFrame) -> DataFrame:
    return (labels.filter("doc_id is not null and quality is not null")
            .groupBy(F.col("doc_id").alias("__id")).agg(F.min("quality").alias("quality")))


def fit_from(docs: DataFrame, labels: DataFrame) -> LineField:
    """Fit on at most FIT_DOCS labelled documents of at most FIT_CHARS characters, chosen by hash; one text per id."""
    chosen = bounded_sample(_known(labels), FIT_DOCS, "__id")
    rows = (docs.select("doc_id", "text").filter(F.length("text") <= FIT_CHARS)
            .join(F.broadcast(chosen), F.col("doc_id") == F.col("__id"))
            .groupBy("doc_id", "quality").agg(F.min("text").alias("text")).collect())
    rows = sorted(rows, key=lambda r: r.doc_id)
    return fit([r.text for r in rows], [int(r.quality == 1) for r in rows])


def threshold_from(shares: DataFrame, labels: DataFrame) -> float:
    """Threshold from ``shares (doc_id, content_share)`` of all rows; an id that repeats counts once, by its lowest."""
    good = _known(labels).filter("quality = 1")
    lowest = shares.groupBy("doc_id").agg(F.min("content_share").alias("content_share"))
    at = (lowest.join(good, F.col("doc_id") == F.col("__id"), "left_semi")
          .agg(F.percentile_approx("content_share", LOSS, 100_000)).first()[0])
    return 0.0 if at is None else min(0.8, at)


SCHEMA = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "content_share double, base_failed boolean")


def _assess(field: LineField):
    @F.pandas_udf(SCHEMA)
    def assess(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in texts:
            rows = []
            for t in s:
                t = t or ""
                c = base_counts(t)
                failed = c[0] < MIN_WORDS or 100 * c[4] > MAX_REPEAT * c[0]
                rows.append((*c, field.share(t), failed))
            yield pd.DataFrame(rows, columns=[x.split()[0] for x in SCHEMA.split(", ")])
    return assess


def assess(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id`` and the verdict's columns, one row per input row.

    A null or empty text has no words: all counts 0, base_failed, not kept.
    Rows that repeat an id are judged each on its own text; null ids stay
    null; other columns are ignored; empty tables give no rows. Without labels
    of both kinds every line counts as content and the base rule alone decides.
    """
    small_batches(docs.sparkSession)
    verdict = _assess(fit_from(docs, labels))
    judged = stored(docs.select("doc_id", verdict("text").alias("v")).select("doc_id", "v.*"), "quality-verdicts")
    return judged.withColumn("kept", _stays(threshold_from(judged, labels)))


def _stays(threshold: float, of: str = "") -> Column:
    return ~F.col(f"{of}base_failed") & (F.col(f"{of}content_share") >= threshold)


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of ``docs`` that the rules keep, columns unchanged (extra ones included)."""
    small_batches(docs.sparkSession)
    field = fit_from(docs, labels)
    verdict = _assess(field)

    @F.pandas_udf("double")
    def share(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in texts:
            yield pd.Series([field.share(t or "") for t in s], dtype="float64")

    threshold = threshold_from(docs.select("doc_id", share("text").alias("content_share")), labels)
    cols = docs.columns
    return (docs.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("__row"),
                        verdict("text").alias("__v")).filter(_stays(threshold, "__v."))
            .select(*[F.col(f"__row.`{c}`").alias(c) for c in cols]))
