"""Personal data by candidate generation and boosted trees, in DataFrame operations only.

Generators with high recall propose spans (they may overlap). Base spans are
the candidates of the four fixed patterns that pass their checks; they always
stay. Candidates of the other generators (obfuscated mail, phones without the
plus sign) have no check; boosted trees score them on format features (digits,
groups, separators) and context features (neighbouring characters, cue words).
Their labelled examples are made from the table: base mails and phones rewritten
into these forms in their real context are positive, look-alike numbers and
phrases in the context of base spans and of failed digit runs negative. The trees
are fitted on a bounded sample; the threshold of each kind is the lowest with
``PRECISION`` over all examples outside the half that the sample comes from.
Candidates above it that touch no base span are added.

Positions come from splitting a text at the matches of a pattern: the pieces
between matches and the matches themselves, in order, give running lengths.
Only candidates are shuffled, never texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from auctide.llm.common import bounded_sample, stored, text_or_empty

KINDS = ("email", "ip", "card", "phone")
#: Examples used to fit the trees, chosen by hash; precision of added spans, and positives that show it at least.
FIT_ROWS, PRECISION, SHOWN = 20_000, 0.99, 20
#: Characters kept on each side of a candidate.
CONTEXT = 24
_LOCAL = "A-Za-z0-9._%+-"

#: (generator, kind, cheap test, pattern). The first of each kind is its base pattern. Repeats are
#: possessive and a start inside a run is skipped where no other reading can match.
GENERATORS = (
    ("email", "email", "@", rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    ("ip", "ip", r"[0-9]\.[0-9]", r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    ("card", "card", r"[0-9][\x20-]?[0-9]", r"[0-9](?:[\x20-]?[0-9])++"),
    ("phone", "phone", r"\+[0-9]", r"\+[0-9][\x20().0-9-]+[0-9]"),
    ("email_at", "email", r"(?i)[(\[{]at[)\]}]",
     rf"(?i)(?<![{_LOCAL}])[{_LOCAL}]++\x20?[(\[{{]at[)\]}}]\x20?[A-Za-z0-9-]++"
     r"(?:(?:\.|\x20?[(\[{]dot[)\]}]\x20?)[A-Za-z0-9-]++)++"),
    ("phone_bare", "phone", r"[0-9][)\x20.-]",
     r"(?<![0-9+.-])(?:\([0-9]{2,4}\)|[0-9]{2,4})[\x20.-]{1,2}[0-9]{3,4}[\x20.-][0-9]{3,4}(?![0-9.-])"),
)


def _digits(c: str) -> Column:
    return F.regexp_replace(F.col(c), "[^0-9]", "")


def _luhn(c: str) -> Column:
    """Checksum of the digits of a candidate; every second digit from the right counts double."""
    d = F.transform(F.split(F.reverse(_digits(c)), ""), lambda x: F.coalesce(x.try_cast("int"), F.lit(0)))
    total = F.aggregate(
        F.transform(d, lambda x, i: F.when(i % 2 == 0, x).when(x > 4, 2 * x - 9).otherwise(2 * x)),
        F.lit(0), lambda a, x: a + x)
    return total % 10 == 0


def _octets(c: str) -> Column:
    parts = F.transform(F.split(F.col(c), r"\."), lambda p: F.regexp_replace(p, "^0+", ""))
    return ~F.exists(parts, lambda p: (F.length(p) > 3) | (F.coalesce(p.try_cast("int"), F.lit(0)) > 255))


def _passes() -> Column:
    n = F.length(_digits("hit"))
    g = F.col("generator")
    return (F.when(g == "email", F.lit(True)).when(g == "ip", _octets("hit"))
            .when(g == "card", n.between(16, 19) & _luhn("hit"))
            .when(g == "phone", n.between(8, 15)).otherwise(F.lit(False)))


def _row_candidates() -> Column:
    """All candidates of one text: array of (generator, kind, number, gap before, hit, left, right)."""
    text = F.col("__text")
    return F.concat(*[_matches(text, *g) for g in GENERATORS])


def _matches(text: Column, name: str, kind: str, test: str, pattern: str) -> Column:
    pieces, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    ahead = F.transform(F.slice(pieces, 2, F.size(pieces)), lambda p: F.substring(p, 1, CONTEXT))
    rows = F.zip_with(F.slice(pieces, 1, F.size(pieces) - 1), hits,
                      lambda p, h: F.struct(p.alias("p"), h.alias("h")))
    rows = F.zip_with(rows, ahead, lambda r, a: F.struct(
        F.length(r["p"]).alias("gap"), r["h"].alias("hit"), F.right(r["p"], F.lit(CONTEXT)).alias("left"),
        a.alias("right")))
    rows = F.transform(rows, lambda r, i: F.struct(
        F.lit(name).alias("generator"), F.lit(kind).alias("kind"), i.alias("number"), r["gap"].alias("gap"),
        r["hit"].alias("hit"), r["left"].alias("left"), r["right"].alias("right")))
    return F.when(text.rlike(test), rows).otherwise(F.array().cast(_CANDIDATES))


_CANDIDATES = ("array<struct<generator:string,kind:string,number:int,gap:int,hit:string,left:string,"
               "right:string>>")


def _located(rows: DataFrame) -> DataFrame:
    """One row per candidate of ``rows (uid, found)`` with ``start`` and ``end`` in code points."""
    c = rows.select("uid", F.explode("found").alias("c")).select("uid", "c.*")
    upto = Window.partitionBy("uid", "generator").orderBy("number").rowsBetween(Window.unboundedPreceding, 0)
    size = F.length("hit")
    return (c.withColumn("end", F.sum(F.col("gap") + size).over(upto))
            .withColumn("start", F.col("end") - size).withColumn("base", _passes()))


CUES = {"cue_phone": r"(?i)tel|phone|call|fax|mobil", "cue_mail": r"(?i)mail|contact|write",
        "cue_card": r"(?i)card|visa|iban|pay|account", "cue_host": r"(?i)\bip\b|host|server|address",
        "cue_version": r"(?i)version|licen[cs]e|release|chapter|section|page"}


def _features(c: DataFrame) -> tuple[DataFrame, list[str]]:
    hit, digits = F.col("hit"), F.length(_digits("hit"))

    def kind_of(side: Column) -> Column:
        return F.when(side == "", 0).when(side.rlike(r"\s"), 1).when(side.rlike("[0-9]"), 2).when(
            side.rlike(r"\p{L}"), 3).otherwise(4)

    f = {
        **{f"is_{k}": F.col("kind") == k for k in KINDS},
        "digits": digits, "chars": F.length(hit), "letters": F.length(F.regexp_replace(hit, "[^A-Za-z]", "")),
        "seps": F.length(F.regexp_replace(hit, r"[^\x20().-]", "")), "dots": F.length(F.regexp_replace(hit, "[^.]", "")),
        "groups": F.regexp_count(hit, F.lit("[0-9]+")), "luhn": _luhn("hit") & digits.between(12, 19),
        "octets": _octets("hit"),
        "domain": hit.rlike(r"(?i)(?:\.|dot[)\]}]\x20?)(?:com|org|net|edu|gov|info|[a-z]{2})$"),
        "longest": F.coalesce(F.array_max(F.transform(F.split(hit, "[^0-9]+"), lambda p: F.length(p))), F.lit(0)),
        "before": kind_of(F.right("left", F.lit(1))), "after": kind_of(F.substring("right", 1, 1)),
        **{n: F.concat_ws(" ", "left", "right").rlike(p) for n, p in CUES.items()},
    }
    return c.withColumns({f"f_{n}": v.cast("double") for n, v in f.items()}), [f"f_{n}" for n in f]


class SpanModel:
    """Boosted trees and a threshold per kind; ``trees`` is None where there was nothing to learn from."""

    def __init__(self, trees=None, thresholds: dict | None = None):
        self.trees, self.thresholds = trees, thresholds or {}

    def score(self, candidates: DataFrame) -> DataFrame:
        """Adds ``score``: probability that a candidate is personal data of its kind."""
        from pyspark.ml.feature import VectorAssembler
        from pyspark.ml.functions import vector_to_array
        if self.trees is None:
            return candidates.withColumn("score", F.lit(0.0))
        rows, names = _features(candidates)
        rows = VectorAssembler(inputCols=names, outputCol="__x").transform(rows)
        out = self.trees.transform(rows).withColumn("score", vector_to_array("probability")[1])
        return out.select(*candidates.columns, "score")

    def added(self, candidates: DataFrame) -> DataFrame:
        """Candidates without a check whose score reaches the threshold of their kind."""
        least = F.lit(2.0)
        for kind, t in self.thresholds.items():
            least = F.when(F.col("kind") == kind, t).otherwise(least)
        return self.score(candidates.filter(~F.col("generator").isin(*KINDS))).filter(F.col("score") >= least)


def examples(candidates: DataFrame) -> DataFrame:
    """``kind, hit, left, right, y``: labelled examples for the generators without a check."""
    h = F.xxhash64("hit", "left", "right")
    n = F.lpad(F.pmod(h, F.lit(10**12)).cast("string"), 12, "7")

    def one_of(*forms: Column, shift: int = 0) -> Column:
        return F.element_at(F.array(*forms), (F.pmod(F.shiftright(h, shift), F.lit(len(forms))) + 1).cast("int"))

    def groups(d: Column, sizes: tuple, sep: str) -> Column:
        starts = [1 + sum(sizes[:i]) for i in range(len(sizes))]
        return F.concat_ws(sep, *[F.substring(d, a, k) for a, k in zip(starts, sizes)])

    at = one_of(*map(F.lit, (" [at] ", "(at)", " (at) ", "{at}")))
    dot = one_of(*map(F.lit, (".", " [dot] ", "(dot)")), shift=4)
    local, domain = F.split_part("hit", F.lit("@"), F.lit(1)), F.split_part("hit", F.lit("@"), F.lit(2))
    mail = F.concat(local, at, F.regexp_replace(domain, F.lit(r"\."), dot))
    d = F.right(_digits("hit"), F.lit(10))
    phone = one_of(F.concat(F.lit("("), F.substring(d, 1, 3), F.lit(") "), F.substring(d, 4, 3), F.lit("-"),
                            F.substring(d, 7, 4)), *[groups(d, (3, 3, 4), x) for x in "- ."])
    word = F.regexp_extract("left", r"([A-Za-z]+)[^A-Za-z]*$", 1)
    after = F.regexp_extract("right", r"([A-Za-z]+)", 1)
    no_mail = one_of(F.concat(word, at, F.substring(n, 1, 3), F.lit("."), F.substring(n, 4, 2)),
                     F.concat(word, at, after, F.lit("."), F.substring(n, 1, 2)),
                     F.concat(word, at, after, F.lit(".The")), shift=8)
    no_phone = one_of(*[groups(n, k, x) for k in ((2, 3, 3), (3, 3, 3), (4, 4, 4)) for x in ". "], shift=8)
    g, base = F.col("generator"), F.col("base")

    def example(kind: str, hit: Column, y: int, when: Column) -> Column:
        return F.when(when, F.struct(F.lit(kind).alias("kind"), hit.alias("hit"), F.lit(float(y)).alias("y")))

    spans = base & g.isin("email", "phone")
    failed = (g == "card") & ~base
    made = F.array_compact(F.array(
        example("email", mail, 1, base & (g == "email")), example("phone", phone, 1, base & (g == "phone")),
        example("email", no_mail, 0, spans | failed), example("phone", no_phone, 0, spans | failed)))
    rows = candidates.select(F.explode(made).alias("e"), "left", "right").select("e.*", "left", "right")
    form = {kind: pattern for name, kind, _, pattern in GENERATORS if name not in KINDS}
    return rows.filter(
        F.when(F.col("kind") == "email", F.col("hit").rlike(f"^(?:{form['email']})$"))
        .otherwise(F.col("hit").rlike(f"^(?:{form['phone']})$")))


def fit(candidates: DataFrame) -> SpanModel:
    """Trees on a bounded sample of half of the examples, thresholds on all of the other half."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler
    rows = examples(candidates).withColumn("part", F.pmod(F.xxhash64("hit", "left", "right"), F.lit(2)))
    sample, names = _features(bounded_sample(rows.filter("part = 0"), FIT_ROWS, "hit", "left", "right"))
    sample = stored(sample.select("y", *names), "pii-fit")
    if sample.select("y").distinct().count() < 2:
        return SpanModel()
    sample = VectorAssembler(inputCols=names, outputCol="x").transform(sample)
    trees = GBTClassifier(featuresCol="x", labelCol="y", maxIter=10, maxDepth=4, stepSize=0.3, seed=3).fit(sample)
    trees.setFeaturesCol("__x")
    model = SpanModel(trees)
    steps = (model.score(rows.filter("part = 1")).groupBy("kind", F.floor(F.col("score") * 1000).alias("step"))
             .agg(F.sum("y").alias("good"), F.count("*").alias("n")).collect())
    for kind in KINDS:
        good = n = 0
        for r in sorted((r for r in steps if r.kind == kind), key=lambda r: -r.step):
            good, n = good + r.good, n + r.n
            if good >= SHOWN and good >= PRECISION * n and r.step >= 500:
                model.thresholds[kind] = r.step / 1000
    return model


def _spans(rows: DataFrame) -> DataFrame:
    """``uid, kind, start, end, base`` of base spans and of added ones, from ``rows (uid, found)``."""
    c = stored(_located(rows), "pii-candidates")
    model = fit(c)
    rest = model.added(c)
    base = c.filter("base").select("uid", "kind", "start", "end", "base")
    rest = rest.select("uid", "kind", "start", "end", "base")
    touch = base.select(F.col("uid").alias("u"), F.col("start").alias("s"), F.col("end").alias("e"))
    rest = rest.join(touch, (F.col("uid") == F.col("u")) & (F.col("start") < F.col("e"))
                     & (F.col("s") < F.col("end")), "left_anti")
    # of added spans that overlap, the one that starts first and is longest stays
    before = Window.partitionBy("uid").orderBy("start", F.desc("end"), "kind").rowsBetween(
        Window.unboundedPreceding, -1)
    rest = (rest.withColumn("reach", F.max("end").over(before))
            .filter("reach is null or start >= reach").drop("reach"))
    return base.unionByName(rest)


def _found(docs: DataFrame, *keep: Column) -> DataFrame:
    """Rows with a row number that stays the same and their candidates."""
    rows = docs.select(*keep, text_or_empty().alias("__text"))
    return rows.withColumn("uid", F.monotonically_increasing_id()).withColumn("found", _row_candidates())


def _joined(spans: Column) -> Column:
    """kind:start:end of sorted spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _number(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("long")


def detect(docs: DataFrame) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added``: one row per input row.

    Counts and digest are those of the base spans, ``spans`` lists all. A null
    or empty text has none (digest of the empty string). Rows that repeat an
    id are searched each on its own; null ids stay null; other columns are
    ignored; an empty table gives no rows.
    """
    rows = stored(_found(docs, F.col("doc_id")).select("doc_id", "uid", "found"), "pii-rows")
    order = F.element_at(F.create_map(*[F.lit(x) for i, k in enumerate(KINDS) for x in (k, i)]), F.col("kind"))
    per = (_spans(rows.filter(F.size("found") > 0).select("uid", "found"))
           .groupBy("uid").agg(
               F.array_sort(F.collect_list(F.struct(order.alias("o"), "start", "end", "kind", "base"))).alias("s")))
    base = F.filter("s", lambda x: x["base"])
    per = per.select(F.col("uid").alias("u"), base.alias("b"), "s")
    out = rows.select("doc_id", "uid").join(per, F.col("uid") == F.col("u"), "left")
    empty = F.array().cast(per.schema["s"].dataType)
    b, s = F.coalesce("b", empty), F.coalesce("s", empty)
    return out.select(
        "doc_id", *[_number(b, k).alias(f"n_{k}") for k in KINDS],
        F.sha2(_joined(b).cast("binary"), 256).alias("base_sha256"), _joined(s).alias("spans"),
        (F.size(s) - F.size(b)).cast("long").alias("n_added"))


def redact(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` with every span replaced by ``[KIND]``; other columns unchanged.

    Overlapping spans are replaced as one, under the kind that starts first.
    Null texts stay null.
    """
    cols = docs.columns
    rows = stored(_found(docs, F.struct(*[F.col(f"`{c}`") for c in cols]).alias("__row"))
                  .select("__row", "uid", "found"), "pii-rows")
    spans = _spans(rows.filter(F.size("found") > 0).select("uid", "found"))
    w = Window.partitionBy("uid").orderBy("start", F.desc("end"), "kind")
    reach = F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    merged = (spans.withColumn("new", F.coalesce(F.col("start") >= reach, F.lit(True)).cast("int"))
              .withColumn("no", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
              .groupBy("uid", "no").agg(F.min("start").alias("start"), F.max("end").alias("end"),
                                        F.min_by("kind", F.struct("start", -F.col("end"), "kind")).alias("kind")))
    per = merged.groupBy("uid").agg(F.array_sort(F.collect_list(F.struct("start", "end", "kind"))).alias("s"))
    per = per.select(F.col("uid").alias("u"), "s")
    j = rows.drop("found").join(per, F.col("uid") == F.col("u"), "left")
    text, s = F.col("__row.text"), F.col("s")
    prior = F.concat(F.array(F.lit(0).cast("long")), F.transform(s, lambda x: x["end"]))
    parts = F.zip_with(s, F.slice(prior, 1, F.size(s)), lambda x, p: F.concat(
        text.substr((p + 1).cast("int"), (x["start"] - p).cast("int")), F.lit("["), F.upper(x["kind"]), F.lit("]")))
    tail = text.substr((F.element_at(s, -1)["end"] + 1).cast("int"), F.length(text))
    clean = F.when(s.isNull(), text).otherwise(F.concat(F.array_join(parts, ""), tail))
    return j.select(*[(clean if c == "text" else F.col(f"__row.`{c}`")).alias(c) for c in cols])
