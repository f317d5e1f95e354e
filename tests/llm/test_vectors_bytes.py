"""Byte-level BPE, vector codes and centroid clusters against the library and brute force; their edge cases."""
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from auctide.llm import byte_bpe, hilbert_codes, ptolemaic
from auctide.llm import queries as Q
from auctide.llm.integer_vectors import LARGEST, SMALL, squares
from auctide.llm.queries import tokenizer_file
from tests.llm.conftest import odd_rows

SF = "/root/testdata/sf0.001"
PATH = tokenizer_file("byte_bpe_50k.json")
LETTERS = "abcdethe  in er on   a.,;12 3<|s>\n\téüß你好🙂aaaa'lls'S\r\x0b\x85\xa0　\x1c²½\0"


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def unpack(packed):
    return np.frombuffer(packed, "<i4").tolist()


@pytest.fixture(scope="module")
def bpe():
    return byte_bpe.ByteBpe(PATH)


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


def test_byte_bpe_equals_the_library(bpe, library):
    rng = random.Random(5)
    texts = ["".join(rng.choice(LETTERS) for _ in range(rng.randrange(80))) for _ in range(4000)]
    texts += [t[:9] + "<|endoftext|>" + t[9:] + "  <|endoftext|> x" for t in texts[:300]]
    texts += ["x" * 20_000 + " " + "ab" * 10_000, " " * 3000, "é" * 3000, "<|endoftext|><|endoftext", ""]
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [unpack(p) for p in bpe.encode_all(texts)] == want
    assert [bpe.decode(i) for i in want] == [library.decode(i, skip_special_tokens=False) for i in want] == texts


def test_character_classes_equal_the_library(bpe, library):
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for k in range(0, len(points), 40_000):
        texts = [f"a{chr(c)}1{chr(c)} {chr(c)}." for c in points[k:k + 40_000]]
        got = bpe.encode_all(texts)
        assert [unpack(p) for p in got] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_one_by_one_equals_side_by_side(bpe):
    rng = random.Random(6)
    words = {bytes(rng.choice(b"etaoin shrdlu\xc3\xa9\x00\xff1") for _ in range(rng.randrange(1, 40))) for _ in range(3000)}
    words = sorted(words)
    assert [unpack(p) for p in bpe.side_by_side.words(words)] == [bpe.word(w) for w in words]


def test_suffix_automaton_knows_every_ending():
    rng = random.Random(7)
    strings = {bytes(rng.choice(b"abc") for _ in range(rng.randrange(1, 6))): i for i in range(60)}
    auto = byte_bpe.SuffixAutomaton(strings)
    for _ in range(200):
        text = bytes(rng.choice(b"abc") for _ in range(12))
        state = matched = 0
        for i, b in enumerate(text, 1):
            while state and state << 8 | b not in auto.step:
                state = auto.link[state]
                matched = auto.length[state]
            if state << 8 | b in auto.step:
                state, matched = auto.step[state << 8 | b], matched + 1
            else:
                state = matched = 0
            got = [(n, t) for n, t in auto.ends[state] if n <= matched]
            assert got == sorted(((len(s), t) for s, t in strings.items() if text[:i].endswith(s)), reverse=True)


def test_int_table():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 1 << 40, 5000))
    table = byte_bpe.IntTable(keys, np.arange(len(keys)))
    assert (table.find(keys) == np.arange(len(keys))).all()
    other = np.setdiff1d(rng.integers(0, 1 << 40, 5000), keys)
    assert (table.find(other) == -1).all()


def test_byte_bpe_query(spark, library):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = Q.op13_byte_bpe(spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids = library.encode(docs[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), sha(",".join(map(str, ids))))
        assert r.decoded_sha256 == sha(library.decode(ids, skip_special_tokens=False))


def test_byte_bpe_edges(odd, none):
    got = byte_bpe.decode(byte_bpe.encode(odd, PATH), PATH).collect()
    assert sorted((str(r.doc_id), r.text) for r in got) == sorted((str(i), t or "") for i, t, *_ in odd_rows())
    assert all((r.ids == []) == (r.text == "") for r in got)
    assert byte_bpe.digests(byte_bpe.decode(byte_bpe.encode(none, PATH), PATH)).count() == 0


# ------------------------------------------------------------------ vectors

def codes_by_hand(rows, parts=4, entries=256, rounds=4, scale=1024):
    """Plain Python over (vec_id, vector, label) rows, all of one length."""
    kept = [(i, [int(np.floor(scale * float(x))) for x in v], label) for i, v, label in rows
            if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    width = len(kept[0][1]) // parts
    first = sorted(kept, key=lambda r: (r[0] is None, r[0], r[1]))[:entries]
    cut = [[v[p * width:(p + 1) * width] for p in range(parts)] for _, v, _ in kept]
    books = [[v[p * width:(p + 1) * width] for _, v, _ in first] for p in range(parts)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for c in cut:
                groups.setdefault(near(c[p], books[p])[1], []).append(c[p])
            for k, g in groups.items():
                books[p][k] = [sum(xs) // len(g) for xs in zip(*g)]
    found = [[near(c[p], books[p]) for p in range(parts)] for c in cut]
    errors = [sum(d for d, _ in f) for f in found]
    per = {}
    for (_, _, label), e in zip(kept, errors):
        per[label] = per.get(label, 0) + e
    digest = sha(",".join(str(x) for b in books for e in b for x in e))
    return sorted((str(i), "".join(f"{k:02x}" for _, k in f), e, per[label], digest)
                  for (i, _, label), f, e in zip(kept, found, errors))


def test_vector_codes_against_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i), rng.normal(size=8).round(2).tolist(), int(rng.integers(3)) if rng.random() < 0.8 else None)
            for i in rng.permutation(300)]
    rows += [(7, rows[0][1], 1), (None, rows[1][1], None), (400, None, 1), (401, [1.0] * 7 + [None], 1),
             (402, [float("nan")] * 8, 1), (403, [float("-inf")] + [0.0] * 7, 2)]
    df = spark.createDataFrame([(*r, 5) for r in rows], "vec_id long, embedding array<double>, label int, rid int")
    got = hilbert_codes.encode_vectors(df.repartition(5), entries=16).collect()
    assert sorted((str(r.vec_id), r.code, r.error, r.label_error, r.codebooks_sha256) for r in got) == \
        codes_by_hand(rows, entries=16)


def test_vector_codes_edges(spark):
    schema = "vec_id long, embedding array<float>, label int, code string"
    none = spark.createDataFrame([], schema)
    assert hilbert_codes.encode_vectors(none).count() == 0
    rows = [(1, [1.0, 2.0, 3.0, 4.0], 0, "x"), (2, [1.0, 2.0, 3.0, 4.0], 0, "x"), (2, [1.0, 2.0, 3.0, 4.0], None, "x"),
            (3, [1.0, 2.0], 0, "x"), (4, [], None, "x"), (5, [1.0] * 8, 1, "x")]
    r = sorted((x.vec_id, x.code, x.error, x.label_error)
               for x in hilbert_codes.encode_vectors(spark.createDataFrame(rows, schema)).collect())
    assert r[:2] == [(1, "00000000", 0, 0), (2, "00000000", 0, 0)] and len(r) == 6
    assert r[3] == (3, None, None, 0) and r[4] == (4, None, None, 0) and r[5] == (5, None, None, None)
    big = spark.createDataFrame([(1, [float(LARGEST)] * 4, 0, "x")], schema)
    with pytest.raises(Exception, match="component too large"):
        hilbert_codes.encode_vectors(big).collect()


def test_equal_vectors_fill_many_blocks(spark):
    """One vector holds most rows: its blocks have a shortlist of one and take their sums as they are."""
    rng = np.random.default_rng(4)
    some = [(i, rng.normal(size=8).round(2).tolist(), 0) for i in range(40)]
    rows = some + [(100 + i, some[0][1], 0) for i in range(3000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = hilbert_codes.encode_vectors(df, entries=8, rounds=2).collect()
    assert sorted((str(r.vec_id), r.code, r.error, r.label_error, r.codebooks_sha256) for r in got) == \
        codes_by_hand(rows, entries=8, rounds=2)


def test_shortlists_hold_every_nearest_entry():
    rng = np.random.default_rng(5)
    for _ in range(200):
        p = rng.integers(-40, 40, (30, 4)) // int(rng.integers(1, 20)) + rng.integers(-100, 100, 4)
        entries = rng.integers(-120, 120, (40, 4))
        short = hilbert_codes.shortlist(p.min(0), p.max(0), entries)
        assert set(squares(p, entries).argmin(axis=1)) <= set(short.tolist()) and (np.diff(short) > 0).all()


@pytest.mark.parametrize("dims, bits", [(2, 4), (3, 3), (5, 2)])
def test_hilbert_neighbours_touch(dims, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
    keys = hilbert_codes.hilbert_keys(cells, bits)
    assert sorted(keys.tolist()) == list(range(len(cells)))  # every cell has a place of its own
    assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def test_exact_squares_for_large_components():
    rng = np.random.default_rng(6)
    for top in (10, SMALL - 1, LARGEST - 1):
        x, y = rng.integers(-top, top + 1, (20, 64)), rng.integers(-top, top + 1, (9, 64))
        want = [[sum((int(a) - int(b)) ** 2 for a, b in zip(p, q)) for q in y] for p in x]
        assert squares(x, y).tolist() == want


@pytest.mark.parametrize("top", [3, 60, LARGEST - 1])
def test_ptolemaic_bounds_never_exceed_the_distance(top):
    rng = np.random.default_rng(7)
    for dims in (2, 8, 64):
        pivots = ptolemaic.Pivots(rng.integers(-top, top + 1, (9, dims)))
        for near in (False, True):
            c = pivots.points + rng.integers(-1, 2, (9, dims)) if near else rng.integers(-top, top + 1, (9, dims))
            c = np.clip(c, -LARGEST + 1, LARGEST - 1)
            x = rng.integers(-top, top + 1, (300, dims))
            low = pivots.bounds(squares(x, pivots.points), c)
            assert all(float(a) <= int(b) for a, b in zip(low.ravel().tolist(), squares(x, c).ravel().tolist()))


def test_nearest_is_exact_and_measures_less():
    rng = np.random.default_rng(8)
    centres = rng.integers(-50, 50, (16, 64))
    x = centres[rng.integers(0, 16, 2000)] + rng.integers(-4, 5, (2000, 64))
    pivots = ptolemaic.Pivots(x[:16])
    for c in (x[:16], centres, np.repeat(centres[:4], 4, axis=0)):
        best, d, measured = ptolemaic.nearest(x, squares(x, pivots.points), c, pivots)
        want = squares(x, c)
        assert (best == want.argmin(axis=1)).all() and (d == want.min(axis=1)).all()
    assert ptolemaic.nearest(x, squares(x, pivots.points), x[:16], pivots)[2] < 16 * len(x) / 4


def clusters_by_hand(rows, k=16, rounds=3, dim=64, scale=64):
    kept = [(i, [int(np.floor(scale * float(x))) for x in v]) for i, v in rows
            if v is not None and len(v) == dim and all(x is not None and np.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (sha(f"1:{'null' if r[0] is None else r[0]}"), r[1]))[:k]
    centres = [v for _, v in first]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centres))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        for n, g in groups.items():
            centres[n] = [sum(xs) // len(g) for xs in zip(*g)]
    found = [near(v) for _, v in kept]
    per = {}
    for d, n in found:
        per[n] = per.get(n, 0) + d
    return sorted((str(i), n, d, per[n], sum(per.values()), sha(",".join(map(str, centres[n]))))
                  for (i, _), (d, n) in zip(kept, found))


def test_clusters_against_brute_force(spark):
    rng = np.random.default_rng(9)
    rows = [(i, (rng.normal(size=64) / 4 + i % 5).round(3).tolist()) for i in range(400)]
    rows += [(3, rows[3][1]), (3, rows[4][1]), (None, rows[5][1]), (900, None), (901, rows[0][1][:63]), (902, []),
             (903, [None] + rows[0][1][1:]), (904, [float("inf")] + rows[0][1][1:]), (905, [float("nan")] * 64)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, cluster string, c int")
    for part in (df.repartition(4), df.filter("vec_id < 9")):
        ids = {r.vec_id for r in part.select("vec_id").collect()}
        want = clusters_by_hand([r for r in rows if r[0] in ids])
        got = ptolemaic.cluster(part).collect()
        assert sorted((str(r.vec_id), r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256)
                      for r in got) == want
    assert ptolemaic.cluster(df.limit(0)).count() == 0
    assert ptolemaic.cluster(df.filter("vec_id = 900")).count() == 0
    big = df.filter("vec_id = 1").withColumn("embedding", F.transform("embedding", lambda x: x + 1e9))
    with pytest.raises(Exception, match="component too large"):
        ptolemaic.cluster(big).collect()
