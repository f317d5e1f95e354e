"""Nulls, empty and very long texts, ties, repeated rows, empty tables, clashing extra columns."""
from collections import Counter

import pytest

import corpus_pipeline
from auctide.llm import chat, embed_dedup, langid, lm_score, mix, pii, piece_wfst, quality, simhash, token_count
from auctide.llm.queries import tokenizer_file
from tests.llm.conftest import LONG, odd_rows

N = len(odd_rows())


def by_id(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.doc_id, []).append(r)
    return out


def test_mix(odd, none):
    r = by_id(mix.mix(odd))
    assert sum(map(len, r.values())) == N
    assert r[3][0].size == 0 and r[3][0].taken == 0 and r[4][0].taken == 0
    assert len(r[2]) == 2 and all(x.taken <= 2 * x.size for v in r.values() for x in v)
    assert mix.mix(none).count() == 0


def test_mixed_documents(odd, none):
    out = mix.mixed_documents(odd)
    assert out.columns == odd.columns
    words = sum(len(x.text.encode().split()) for x in out.collect())
    assert words == sum(x.taken for x in mix.mix(odd).collect())
    assert mix.mixed_documents(none).count() == 0


def test_simhash(odd, none):
    r = by_id(simhash.label(odd))
    assert sum(map(len, r.values())) == N
    assert {x.component_id for i in (1, 2) for x in r[i]} == {1}
    assert r[3][0].fp == r[4][0].fp == r[5][0].fp == 0 and r[5][0].component_id == 3
    assert simhash.label(none).count() == 0


def test_drop_near_copies(odd, none):
    out = simhash.drop_near_copies(odd)
    assert out.columns == odd.columns
    assert Counter(x.doc_id for x in out.collect()) == Counter([1, 3, 6, None, 7, 8])
    assert simhash.drop_near_copies(none).count() == 0


def test_personal_data(odd, none):
    r = by_id(pii.detect(odd))
    assert sum(map(len, r.values())) == N
    x = r[8][0]
    assert (x.n_email, x.n_ip, x.n_card, x.n_phone) == (1, 1, 1, 1)
    assert r[3][0].spans == "" and r[4][0].n_email == 0
    assert pii.detect(none).count() == 0
    out = pii.redact(odd)
    assert out.columns == odd.columns and out.count() == N
    t = {x.doc_id: x.text for x in out.collect()}
    assert t[8] == "mail [EMAIL] ip [IP] or [PHONE] card [CARD]." and t[3] is None and t[6] == LONG
    assert pii.redact(none).count() == 0


def test_token_counts(odd, none):
    path = tokenizer_file("word_bpe_49k.json")
    r = by_id(token_count.count_tokens(odd, path))
    assert sum(map(len, r.values())) == N
    assert (r[3][0].n_bytes, r[3][0].n_tokens, r[3][0].over_limit) == (0, 0, False)
    assert r[6][0].over_limit and r[5][0].n_tokens == 0
    assert token_count.count_tokens(none, path).count() == 0


def test_lm_score(odd, none):
    r = by_id(lm_score.score(odd))
    assert sum(map(len, r.values())) == N
    assert r[3][0].n_tokens == r[4][0].n_tokens == 1 and r[3][0].score == r[4][0].score
    assert all(x.score < 0 and x.base_score < 0 for v in r.values() for x in v)
    assert lm_score.score(none).count() == 0


def test_quality(odd, none, labels):
    r = by_id(quality.assess(odd, labels))
    assert sum(map(len, r.values())) == N
    assert r[3][0].base_failed and not r[3][0].kept and r[1][0].kept
    assert r[6][0].base_failed and r[6][0].n_repeat_words == 30_000
    assert quality.assess(none, labels).count() == 0
    out = quality.keep_good(odd, labels.limit(0))
    assert out.columns == odd.columns and Counter(x.doc_id for x in out.collect()) == Counter([1, 2, 2])


def test_language(odd, none):
    r = by_id(langid.identify(odd))
    assert sum(map(len, r.values())) == N
    assert r[3][0].lang_pred == r[5][0].lang_pred == "und" and r[3][0].score == 0
    assert all(0 <= x.score <= 1 for v in r.values() for x in v)
    assert langid.identify(none).count() == 0
    unlabelled = odd.drop("lang").selectExpr("*", "cast(null as string) as lang")
    assert {x.lang_pred for x in langid.identify(unlabelled).collect()} == {"und"}


def test_pieces(odd, none):
    path = tokenizer_file("piece_bpe_32k.model")
    r = by_id(piece_wfst.encode(odd, path))
    assert sum(map(len, r.values())) == N
    assert r[3][0].ids == [] and r[3][0].round_trip and r[6][0].round_trip and not r[7][0].round_trip
    assert piece_wfst.encode(none, path).count() == 0


def test_chat(spark):
    rows = [(1, 0, "user", "hi", "x"), (1, 1, "assistant", None, "x"), (None, 0, None, "<|im_end|>\n", "x"),
            (2, None, "a\nb\\n<|", "<\\|im_start|>", "x"), (2, 0, "assistant", "ok", "x"), (2, 0, "assistant", "ok", "x")]
    conv = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, id string")
    r = {x.conv_id: x for x in chat.format_digests(conv).collect()}
    assert {k: v.n_turns for k, v in r.items()} == {1: 2, None: 1, 2: 3}
    assert r[2].loss_chars == 4 and r[1].loss_chars == 0
    assert chat.format_digests(conv.limit(0)).count() == 0
    assert chat.format_conversations(conv).count() == 3


def test_embeddings(spark):
    v = [1.0, 0.5, 0.25]
    rows = [(1, v, 0), (2, v, 0), (2, v, 0), (3, [2.0, 1.0, 0.5], 0), (4, v, 1), (5, v, None), (6, None, 0),
            (7, [0.0, 0.0, 0.0], 0), (8, [1.0, None, 2.0], 0), (9, [float("nan"), 1.0, 1.0], 0), (10, [], 0),
            (None, v, 0), (11, [1.0, 0.5], 0), (12, [float("inf"), 0.0, 1.0], 0), (13, [-1.0, -0.5, -0.25], 0)]
    e = spark.createDataFrame([(*r, 5) for r in rows],
                              "vec_id long, embedding array<float>, label int, rid int")
    r = {}
    for x in embed_dedup.near_duplicates(e).collect():
        r.setdefault(x.vec_id, []).append((x.n_links, x.component_id, x.kept))
    assert r[1] == [(4, 1, True)] and r[2] == [(4, 1, False)] * 2 and r[3] == [(4, 1, False)]
    assert r[None] == [(4, 1, False)]
    assert all(r[i] == [(0, i, True)] for i in (4, 5, 6, 7, 8, 9, 10, 11, 12, 13))
    assert embed_dedup.near_duplicates(e.limit(0)).count() == 0


@pytest.mark.parametrize("k", range(len(corpus_pipeline.STAGES)))
def test_stages(spark, odd, none, labels, tmp_path, k):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    _, stage = corpus_pipeline.STAGES[k]
    for docs in (odd, none):
        out = stage(spark, docs, str(tmp_path))
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.dtypes == docs.dtypes
        assert out.count() <= 2 * docs.count()
