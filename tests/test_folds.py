"""Fold tables: brute-force checks on small key sets and leak properties."""

from itertools import combinations

import pytest
from pyspark.sql import functions as F

from auctide.operators import folds

IDS = [0, 1, 2, 5, 6, 9, 10, 11, 14, 15, 17, 20]  # 12 keys with gaps


def _keys(spark, ids=IDS):
    return spark.createDataFrame([(i,) for i in ids], "date_id int")


def _table(df, fold_col="fold", key="date_id"):
    out = {}
    for r in df.collect():
        out.setdefault((r[fold_col], r["role"]), set()).add(r[key])
    return out


def _blocks(ids, n):
    k, m = divmod(len(ids), n)
    out, i = [], 0
    for b in range(n):
        size = k + (1 if b < m else 0)
        out.append(ids[i:i + size])
        i += size
    return out


def _cpcv_brute(ids, n, t, purge, embargo):
    blocks = _blocks(sorted(ids), n)
    res = {}
    for s, test in enumerate(combinations(range(n), t)):
        train = []
        for b in range(n):
            if b in test:
                continue
            keep = list(blocks[b])
            if b + 1 in test and purge:
                keep = keep[:-purge]
            if b - 1 in test and embargo:
                keep = keep[embargo:]
            train += keep
        res[(s, "train")] = set(train)
        res[(s, "valid")] = {i for b in test for i in blocks[b]}
    return res


@pytest.mark.parametrize("purge", [0, 1, 2])
@pytest.mark.parametrize("embargo", [0, 1, 2])
def test_cpcv_brute_force(spark, purge, embargo):
    got = _table(folds.cpcv(_keys(spark), 4, 2, purge, embargo), "split")
    exp = _cpcv_brute(IDS, 4, 2, purge, embargo)
    assert {k: v for k, v in got.items()} == {k: v for k, v in exp.items() if v}


def test_cpcv_paths_and_counts(spark):
    c = folds.cpcv(_keys(spark), 5, 2).filter("role = 'valid'").select("split", "block", "path").distinct().collect()
    per_block = {}
    for r in c:
        per_block.setdefault(r.block, []).append((r.split, r.path))
    for b, items in per_block.items():
        assert len(items) == 4  # each block is tested in C(4, 1) splits
        assert [p for _, p in sorted(items)] == [1, 2, 3, 4]


def test_cpcv_argument_check(spark):
    with pytest.raises(ValueError):
        folds.cpcv(_keys(spark), 3, 3)


def test_cpcv_gap_zero_parity(spark):
    got = _table(folds.cpcv(_keys(spark), 4, 2, 0, 0, parity=True), "split")
    # split 0 tests blocks 0 and 1; block 2 sits right after a test block, but purge applies
    # to blocks *before* a test block: none here, so train = blocks 2 and 3 in full
    assert got[(0, "train")] == set(IDS[6:])
    # split 1 tests blocks 0 and 2: block 1 (before block 2) is dropped whole under parity
    assert got[(1, "train")] == set(IDS[9:])


def test_kfold_blocks(spark):
    got = _table(folds.kfold(_keys(spark), 5))
    sizes = [len(got[(f, "valid")]) for f in range(5)]
    assert sizes == [3, 3, 2, 2, 2]
    for f in range(5):
        assert not (got[(f, "valid")] & got[(f, "train")])
        assert got[(f, "valid")] | got[(f, "train")] == set(IDS)


def test_time_series_split(spark):
    got = _table(folds.time_series_split(_keys(spark), 3, gap=1))
    s = sorted(IDS)
    test_size = 12 // 4
    for f in range(3):
        start = 12 - 3 * test_size + f * test_size
        assert got[(f, "valid")] == set(s[start:start + test_size])
        assert got[(f, "train")] == set(s[:start - 1])


def test_purged_block_removes_overlap(spark):
    keys = spark.createDataFrame([(i,) for i in range(20)], "date_id int")
    default = _table(folds.purged_block_split(keys, 3, fold_size=6, gap=1))
    parity = _table(folds.purged_block_split(keys, 3, fold_size=6, gap=1, parity=True))
    for f in range(3):
        assert not (default[(f, "train")] & default[(f, "valid")])
    assert parity[(0, "train")] & parity[(0, "valid")]  # the reference's overlap


def test_purged_group_split(spark):
    got = _table(folds.purged_group_split(_keys(spark), 3, group_gap=1))
    s = sorted(IDS)
    gts = 12 // 4
    for f in range(3):
        st = 12 - 3 * gts + f * gts
        assert got[(f, "valid")] == set(s[st:st + gts])
        assert got[(f, "train")] == set(s[:st - 1])
    with pytest.raises(ValueError):
        folds.purged_group_split(_keys(spark, [1, 2]), 3)


def test_group_kfold_greedy(spark):
    rows = [(g, i) for g, n in [(1, 5), (2, 4), (3, 3), (4, 3), (5, 1)] for i in range(n)]
    df = spark.createDataFrame(rows, "stock_id int, i int")
    got = _table(folds.group_kfold(df, 2), key="stock_id")
    # sizes 5,4,3,3,1: 5->f0, 4->f1, 3->f1 (4<5), 3->f0 (5<7), 1->f1 (7<8)
    assert got[(0, "valid")] == {1, 4}
    assert got[(1, "valid")] == {2, 3, 5}
    # ties go to the lowest fold index
    tie = spark.createDataFrame([(g, i) for g in (7, 8) for i in range(2)], "stock_id int, i int")
    t = _table(folds.group_kfold(tie, 2), key="stock_id")
    assert t[(0, "valid")] == {7} and t[(1, "valid")] == {8}


def test_assign_semi_join(spark):
    df = spark.createDataFrame([(i, float(i)) for i in IDS for _ in range(2)], "date_id int, v double")
    f = folds.kfold(_keys(spark), 3)
    assert folds.assign(df, f, 0, "valid").count() == 8
