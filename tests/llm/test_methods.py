"""Each method against a brute-force version, an exact round trip or held-out accuracy."""
import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from auctide.llm import chat, crf, embed_dedup, langid, lm_score, piece_wfst, pii, quality, simhash, token_count
from auctide.llm import queries as Q
from auctide.llm.components import connected_components
from auctide.llm.queries import tokenizer_file

SF = "/root/testdata/sf0.001"
LETTERS = "abcdethe  in er on   a.,;12 3<|s>\n\téüß你好🙂aaaa'lls"


def texts_of(docs):
    return {r.doc_id: r.text for r in docs.collect()}


def reach(ids, linked):
    comp = {i: i for i in ids}
    while True:
        new = {i: min([comp[i], *(comp[j] for j in linked[i])]) for i in ids}
        if new == comp:
            return comp
        comp = new


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 460)]
    edges += [(1000, i) for i in range(1001, 1200)]
    nodes = {x for e in edges if e[0] != e[1] for x in e}
    linked = {n: set() for n in nodes}
    for a, b in edges:
        if a != b:
            linked[a].add(b)
            linked[b].add(a)
    df = spark.createDataFrame([*edges, (None, 1)], "p long, q long")
    assert {r.node: r.component for r in connected_components(df, "p", "q").collect()} == reach(nodes, linked)


def test_simhash_links_are_complete(spark):
    rng = random.Random(2)
    seeds = [rng.getrandbits(64) for _ in range(40)]
    fps = {s for s in seeds}
    for s in seeds:
        for n in (1, 2, 3):
            for _ in range(12):
                f = s
                for b in rng.sample(range(64), n):
                    f ^= 1 << b
                fps.add(f)
    signed = [int(np.array(f, np.uint64).view(np.int64)) for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    for bits in (1, 2, 3):
        got = {(r.x, r.y) for r in simhash.links(df, bits).collect()}
        want = {(min(a, b), max(a, b)) for a, b in itertools.combinations(signed, 2)
                if ((a ^ b) & (2**64 - 1)).bit_count() <= bits}
        assert got == want


def test_simhash_anchors_are_not_broadcast(spark):
    # a table whose size on paper is far below the threshold, before its rows are spread to 34 anchors each
    pairs = simhash.links(spark.range(20_000).select(F.xxhash64("id").alias("fp")))
    pairs.collect()
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_simhash_query(spark, docs):
    import xxhash

    def fp(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sh = [" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))] if w else []
        h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
        return sum((2 * sum(x >> b & 1 for x in h) > len(h)) << b for b in range(64)) if h else 0

    f = {i: fp(t) for i, t in texts_of(docs).items()}
    want = reach(f, {i: [j for j in f if (f[i] ^ f[j]).bit_count() <= 2] for i in f})
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in Q.op2_simhash(spark, SF).collect()}
    assert got == {i: (f"{f[i]:016x}", want[i]) for i in f}


def luhn(d):
    s = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(d))]
    return sum(x - 9 * (x > 9) for x in s) % 10 == 0


PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
            "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
            "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def base_spans(t):
    def ok(k, m):
        d = re.sub("[^0-9]", "", m)
        return (k == "email" or k == "ip" and all(int(x) <= 255 for x in m.split("."))
                or k == "card" and 16 <= len(d) <= 19 and luhn(d) or k == "phone" and 8 <= len(d) <= 15)
    return [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, t) if ok(k, m.group())]


def test_personal_data_base_spans(spark):
    rng = random.Random(3)
    bits = ["a.b@c.de", "x@y", "@z.com", "1.2.3.4", "256.1.1.1", "01.002.3.4", "4111111111111111", "4111-1111 1111 1111",
            "4111111111111112", "+1 (724) 555-7058", "+49 30 1234567", "+1", "é🙂", " ", "\n", ".", "_", "-", "7", "a",
            "12345678901234567890", "1.2.3.4.5.6.7.8", "a@b.c_d@e.f", "+" * 3]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(25))) for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pii.detect(df).collect():
        spans = base_spans(texts[r.doc_id])
        own = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert r.base_sha256 == hashlib.sha256(own.encode()).hexdigest(), texts[r.doc_id]
        assert set(own.split(",")) - {""} <= set(r.spans.split(","))
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in spans) for k in PATTERNS]


def test_personal_data_on_documents(spark, docs):
    texts = texts_of(docs)
    for r in Q.op3_personal_data(spark, SF).collect():
        spans = base_spans(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()


def test_embedding_links(spark):
    rng = np.random.default_rng(4)
    x = rng.standard_normal((60, 24))
    x = np.concatenate([x, x[:20] + 0.2 * rng.standard_normal((20, 24)), x[:10] + 0.3 * rng.standard_normal((10, 24)),
                        np.repeat(x[:1], 30, axis=0) + 0.05 * rng.standard_normal((30, 24)), x[:5]]).astype(np.float32)
    label = rng.integers(0, 2, len(x))
    df = spark.createDataFrame([(i, v.tolist(), int(k)) for i, (v, k) in enumerate(zip(x, label))],
                               "vec_id long, embedding array<float>, label int")
    u = x.astype(float)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    s = (u @ u.T >= 0.93) & (label[:, None] == label[None])
    np.fill_diagonal(s, False)
    want = reach(range(len(x)), {i: np.flatnonzero(s[i]) for i in range(len(x))})
    got = {r.vec_id: (r.n_links, r.component_id) for r in embed_dedup.near_duplicates(df).collect()}
    assert got == {i: (int(s[i].sum()), int(want[i])) for i in range(len(x))}


def test_embedding_blocks_count_every_link_once(monkeypatch):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((1, 8)) + 0.1 * rng.standard_normal((90, 8))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    codes, weight = embed_dedup._codes(x, 2, 3), rng.integers(1, 4, 90)
    total = np.zeros(90, int)
    for t in range(3):
        for c in np.unique(codes[:, t]):
            at = np.flatnonzero(codes[:, t] == c)
            block = at % 3
            for a, b in itertools.combinations_with_replacement(range(3), 2):
                on = (block == a) | (block == b)
                links, _ = embed_dedup._bucket(x[at[on]], weight[at[on]], codes[at[on]], t, block[on], a, b, 0.93)
                total[at[on]] += links
    s = x @ x.T >= 0.93
    np.fill_diagonal(s, False)
    s &= (codes[:, None] == codes[None]).any(axis=2)
    assert (total == s @ weight).all()


def random_texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(LETTERS) for _ in range(rng.randrange(40))) for _ in range(n)]


def test_token_counts(spark, docs):
    from tokenizers import Tokenizer
    path = tokenizer_file("word_bpe_49k.json")
    lib, own = Tokenizer.from_file(path), token_count.word_bpe(path)
    for t in random_texts(1500, 6) + ["<|endoftext|>a<|startoftext|><|endoftext|>", "ΑΣ İ ŉ ﬁ ́é", "x" * 5000]:
        assert own.count(t) == len(lib.encode(t, add_special_tokens=False).ids), t
    for i, t in texts_of(docs).items():
        assert own.count(t) == len(lib.encode(t, add_special_tokens=False).ids), i


def test_prefix_counts(spark):
    from tokenizers import Tokenizer
    path = tokenizer_file("word_bpe_49k.json")
    lib, own = Tokenizer.from_file(path), token_count.word_bpe(path)
    lib.encode_special_tokens = True
    for t in random_texts(60, 7):
        text, counts = own.prefix_counts(t)
        assert list(counts) == [len(lib.encode(text[:i], add_special_tokens=False).ids) for i in range(len(text) + 1)]
    df = spark.createDataFrame([(1, "The quick brown fox, jumping over dogs"), (2, None)], "doc_id long, text string")
    rows = {r.doc_id: r for r in token_count.cut_to_budget(df, path, 4).collect()}
    assert rows[1].n_tokens == 4 and rows[2].text == ""
    longer = "the quick brown fox, jumping over dogs"[:rows[1].n_chars + 1]
    assert len(lib.encode(longer, add_special_tokens=False).ids) > 4


def test_pieces_match_the_library(docs):
    import sentencepiece
    path = tokenizer_file("piece_bpe_32k.model")
    lib, own = sentencepiece.SentencePieceProcessor(model_file=path), piece_wfst.transducer(path)
    rng = random.Random(8)
    names = [p for p in own.ids if len(p) > 1]
    joined = ["".join(rng.choice(names) for _ in range(3)).replace("▁", " ") for _ in range(2000)]
    for t in random_texts(1500, 9) + joined + [" " * n + "a" + " " * n for n in range(40)] + list(texts_of(docs).values()):
        ids = own.encode(t)
        assert ids.tolist() == lib.encode(t), t
        assert own.decode(ids) == t


def test_pieces_query(spark, docs):
    texts = texts_of(docs)
    for r in Q.op10_sentencepiece(spark, SF).collect():
        assert r.round_trip and r.n_pieces == len(r.ids)
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_decode(spark):
    path = tokenizer_file("piece_bpe_32k.model")
    df = spark.createDataFrame([(1, piece_wfst.transducer(path).encode("hé  🙂").tolist()), (2, None)],
                               "doc_id long, ids array<int>")
    assert {r.doc_id: r.text for r in piece_wfst.decode(df, path).collect()} == {1: "hé  🙂", 2: ""}


def test_language_model(spark, docs):
    texts = texts_of(docs)
    tokens = {i: re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + ["\n"]
              for i, t in texts.items()}
    train = [i for i in tokens if zlib.crc32(str(i).encode()) % 7 != 2]
    c = Counter(w for i in train for w in tokens[i])
    n, v = sum(c.values()), len(c)
    held = [0.0, 0.0]
    for r in Q.op6_lm_score(spark, SF).collect():
        t = tokens[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(t), sum(c[w] > 0 for w in t), n)
        assert math.isclose(r.base_score, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t), rel_tol=1e-9)
        assert r.held_out == (r.doc_id not in train)
        if r.held_out:
            held[0] += r.base_score
            held[1] += r.score
    assert held[1] > held[0]


def small_network():
    rng = np.random.default_rng(10)
    words = [(f"w{i}".encode(), int(c)) for i, c in enumerate(sorted(rng.integers(1, 50, 300), reverse=True))]
    tail = {t: (5, 2) for t in range(lm_score.TAIL)}
    return lm_score.Network(lm_score.Lexicon(words, 5000, 364, tail))


def test_network_probabilities_sum_to_one():
    net = small_network()
    h = np.random.default_rng(1).normal(size=(3, lm_score.HIDDEN)).astype(np.float32)
    net.p["wc"] += np.random.default_rng(2).normal(size=net.p["wc"].shape).astype(np.float32)
    every = np.arange(lm_score.VOCAB + lm_score.TAIL)
    for row in h:
        p = np.exp(net.log_probs(np.repeat(row[None], len(every), axis=0), every))
        assert abs(p.sum() - 1) < 1e-3


def test_network_gradient():
    net = small_network()
    rng = np.random.default_rng(3)
    net.p = {k: (v + rng.normal(0, 0.1, v.shape) * (v > -1e8)).astype(np.float64) for k, v in net.p.items()}
    tgt = rng.integers(0, 300, (5, 2)).astype(np.int32)
    inp = np.concatenate([np.full((1, 2), net.BOS, np.int32), tgt[:-1]])
    new = np.zeros((5, 2), bool)
    new[0] = new[3, 1] = True

    def loss():
        h, total = np.zeros((2, lm_score.HIDDEN)), 0.0
        for i in range(5):
            h, _ = net.step(h * ~new[i][:, None], inp[i])
            total += net.log_probs(h, tgt[i]).sum()
        return total / 10

    _, g = net._window(np.zeros((2, lm_score.HIDDEN)), inp, tgt, new)
    for k in ("u", "x", "wc", "ww"):
        at = np.unravel_index(np.abs(g[k]).argmax(), g[k].shape)
        keep, eps = net.p[k][at], 1e-5
        net.p[k][at] = keep + eps
        up = loss()
        net.p[k][at] = keep - eps
        down = loss()
        net.p[k][at] = keep
        assert abs((up - down) / (2 * eps) - g[k][at]) < 1e-4, k


def test_scores_do_not_depend_on_company():
    net = small_network()
    rng = np.random.default_rng(4)
    docs = [rng.integers(0, 300, n).astype(np.int32) for n in (1, 500, 3, 70, 129, 64, 2)]
    together = net.score(docs)
    assert np.allclose(together, [net.score([d])[0] for d in docs], rtol=1e-4)


def test_quality_counts(docs):
    for t in [*texts_of(docs).values(), "a b c d e f g h " * 3, "a\n\na\n \n", "x " * 9]:
        words = t.encode().split()
        win = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
        c = Counter(win)
        covered = {j for i, w in enumerate(win) if c[w] > 1 for j in range(i, i + 8)}
        lines, dup = set(), 0
        for line in t.split("\n"):
            dup += line in lines and bool(re.search(r"[^\x20\x09-\x0D]", line))
            lines.add(line)
        assert quality.base_counts(t) == (
            len(words), len(re.sub(r"[\x20\x09-\x0D]", "", t)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(covered))


def test_quality_verdict_on_labelled_documents(spark):
    sf = "/root/testdata/sf0.01"
    lab = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in Q.op8_quality_rules(spark, sf).collect() if r.doc_id in lab and not r.base_failed]
    good, bad = [r for r in rows if lab[r.doc_id]], [r for r in rows if not lab[r.doc_id]]
    assert sum(r.kept for r in good) >= 0.99 * len(good) and sum(r.kept for r in bad) <= 0.3 * len(bad)


def chain_brute(scores, trans, start):
    t, k = scores.shape
    paths = {p: start[p[0]] + sum(scores[i, y] for i, y in enumerate(p)) + sum(trans[a, b] for a, b in zip(p, p[1:]))
             for p in itertools.product(range(k), repeat=t)}
    z = np.logaddexp.reduce(list(paths.values()))
    m = np.zeros((t, k))
    for p, s in paths.items():
        m[np.arange(t), p] += math.exp(s - z)
    return max(paths, key=paths.get), m


@pytest.mark.parametrize("t", [1, 2, 5])
def test_chain_fields(t):
    rng = np.random.default_rng(t)
    scores, trans, start = rng.normal(size=(t, 3)), rng.normal(size=(3, 3)), rng.normal(size=3)
    best, m = chain_brute(scores, trans, start)
    assert tuple(crf.viterbi(scores, trans, start)) == best
    padded = np.zeros((2, t + 2, 3))
    padded[0, :t] = scores
    u, _, _ = crf.batch_marginals(padded, np.array([t, t + 2]), trans, start)
    assert np.allclose(u[0, :t], m)


def test_chain_of_many_texts_equals_each_alone():
    rng = np.random.default_rng(11)
    trans, start = np.exp(rng.normal(size=(3, 3))), np.exp(rng.normal(size=3))
    sizes = [1, 40, 3, 900, 2, 77]
    emit = np.exp(rng.normal(size=(sum(sizes), 3)))
    first = np.zeros(len(emit), bool)
    first[np.r_[0, np.cumsum(sizes)[:-1]]] = True
    got = crf.chain_marginals(emit, first, trans, start, segments=7)
    at = 0
    for n in sizes:
        u, _, _ = crf.batch_marginals(np.log(emit[None, at:at + n]), np.array([n]), np.log(trans), np.log(start))
        assert np.allclose(got[at:at + n], u[0])
        at += n


def test_language_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    held = [r for r in Q.op9_language_id(spark, sf).collect() if r.held_out]
    assert held and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in held)
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.97 * len(held)


def test_code_switched_words(docs):
    rows = [(r.text, r.lang) for r in docs.collect() if r.text]
    names = sorted({x for _, x in rows})
    model = langid.fit([(t, names.index(x)) for t, x in rows], names, [], rounds=4)
    a = next(t for t, x in rows if x == "fr" and len(t) > 400)
    b = next(t for t, x in rows if x == "de" and len(t) > 400)
    wa, wb = langid.words_of(a)[:40], langid.words_of(b)[:40]
    post = langid.Labeller(model).label([b" ".join(wa + wb).decode()])[0]
    got = [names[k] for k in post.argmax(axis=1)]
    assert got[:35].count("fr") >= 30 and got[-35:].count("de") >= 30


def test_chat_round_trip(spark):
    hard = ["<|im_end|>\n", "<\\|im_end|>", "<", "|", "<\\\\|", "a\nb", "", "\\n", "<|im_start|>assistant\nok<|im_end|>\n"]
    messages = [{"role": r, "text": t} for r in ("user", "assistant", "odd\nrole\\<|") for t in hard]
    text, spans = chat.render(chat.CHATML, messages)
    reader = chat.Reader()
    chat.compile_template(chat.CHATML)(iter(messages), reader)
    turns = "".join(f"{m['role']}\n{m['text']}\n" for m in messages)
    loss = "".join(m["text"] for m in messages if m["role"] == "assistant")
    assert reader.row() == (len(messages), hashlib.sha256(turns.encode()).hexdigest(), len(loss),
                            hashlib.sha256(loss.encode()).hexdigest(), len(text))
    assert "".join(chat.unescape(text[a:b]) for a, b in spans) == loss


def test_template_language():
    render = chat.render
    t = "{% for m in messages %}{% if loop.first %}^{% elif m.role == 'b' and not m.text %}-{% else %}{{ ', ' + m.text }}" \
        "{% endif %}{% endfor %}{% if 'a' + 'b' == 'ab' %}yes{% else %}no{% endif %}"
    assert render(t, [{"role": "a", "text": "x"}, {"role": "b", "text": ""}, {"role": "c", "text": "z"}])[0] == "^-, zyes"
    body, _ = chat._Parser("{% if 'a' + 'b' == 'ab' %}y{{ 'es' }}{% endif %}!").block(())
    assert chat.fold_block(body) == [("text", "yes!")]
    for bad in ("{{ m.__class__.x }}", "{{ open('x') }}", "{% for x in y %}{% endfor %}", "{% if true %}", "{% import os %}",
                "{{ 'a' | unknown }}", "{{ }}", "{{ 1 }}"):
        with pytest.raises(chat.TemplateError):
            chat.compile_template(bad)


def test_pipeline_against_brute_force(spark):
    import corpus_pipeline as P
    from auctide.llm.common import table
    kept = {r.doc_id for r in Q.op8_quality_rules(spark, SF).collect() if r.kept}
    docs = [r for r in table(spark, SF, "documents").collect() if r.doc_id in kept]
    f = {r.doc_id: simhash.fingerprint(r.text) for r in docs}
    comp = reach(f, {i: [j for j in f if (f[i] ^ f[j]).bit_count() <= 2] for i in f})
    text = {}
    for r in docs:
        if comp[r.doc_id] == r.doc_id:
            t, end, out = r.text, 0, ""
            for k, a, b in sorted(base_spans(t), key=lambda s: (s[1], -s[2])):
                if a >= end:
                    out += t[end:a] + f"[{k.upper()}]"
                end = max(end, b)
            text[r.doc_id] = (out + t[end:], r.source)
    sources = sorted({s for _, s in text.values()})
    size = {i: len(t.encode().split()) for i, (t, _) in text.items()}
    total = {s: sum(size[i] for i in text if text[i][1] == s) for s in sources}
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(sources)}
    lo, hi = 0.0, max(2 * total[s] / weight[s] for s in sources)
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if sum(min(2 * total[s], weight[s] * mid) for s in sources) < 1.5 * sum(total.values()) else (lo, mid)
    want = Counter()
    for s in sources:
        at = 0
        goal = min(2 * total[s], weight[s] * hi)
        order = sorted((i for i in text if text[i][1] == s), key=lambda i: hashlib.md5(f"mix:{i}".encode()).hexdigest())
        for i in order * 2:
            n = max(0, min(size[i], math.floor(goal + 1e-6) - at))
            at += size[i]
            if n:
                t = text[i][0] if n == size[i] else b" ".join(text[i][0].encode().split()[:n]).decode()
                want[(i, hashlib.sha256(t.encode()).hexdigest())] += 1
    rows = P.run(spark, SF).collect()
    assert Counter((r.doc_id, r.decoded_sha256) for r in rows) == want


def test_language_model_learns_from_every_row(spark):
    rng = random.Random(12)
    ring = [f"ring{i}" for i in range(12)]
    rows = [(i, " ".join(rng.choice(ring) for _ in range(30))) for i in range(40)]
    rows += [(100 + i, " ".join(ring[(i + k) % 12] for k in range(4500))) for i in range(8)]  # over 20,000 characters
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    held = [r for r in lm_score.score(docs).collect() if r.held_out and r.doc_id >= 100]
    assert held and all(r.score > 0.3 * r.base_score for r in held)
    _, lex, net = lm_score.fit_from(docs, F.lit(False))
    assert lex.n == sum(len(t.split()) + 1 for _, t in rows)
    assert lm_score.learn(docs, lex, net) == 2 * lex.n


def test_language_model_passes_do_not_depend_on_size(spark):
    docs = spark.createDataFrame([(i, "a b c d") for i in range(30)], "doc_id long, text string")
    _, lex, net = lm_score.fit_from(docs, F.lit(False))
    tokens, lex.n = lex.n, 5_000_000  # as many as the former switch to one pass asked for
    assert lm_score.learn(docs, lex, net) == 2 * tokens


def test_blocks_hold_every_document_whole():
    rng = np.random.default_rng(13)
    docs = [rng.integers(0, 99, n) for n in (1, 700, 3, 40, 129, 64, 2)]
    lanes = [[] for _ in range(3)]
    for tgt, new in lm_score.blocks(docs, 3, 16):
        for k in range(3):
            for x, first in zip(tgt[:, k], new[:, k]):
                if first:
                    lanes[k].append([])
                if x >= 0:
                    lanes[k][-1].append(int(x))
    assert sorted(d for lane in lanes for d in lane) == sorted(d.tolist() for d in docs)


def invented(rng, n, letters):
    return ["".join(rng.choice(letters) for _ in range(rng.randrange(3, 8))) for _ in range(n)]


def test_rare_language_is_learned(spark, monkeypatch):
    rng = random.Random(14)
    common, rare = invented(rng, 3000, "abcdefghij"), invented(rng, 60, "abcdeuvwxy")
    rows = [(i, " ".join(rng.choice(common) for _ in range(40)), "aa") for i in range(4000)]
    rows += [(9000 + i, " ".join(rng.choice(rare) for _ in range(40)), "bb") for i in range(6)]
    rows += [(9100, " ".join(rng.choice(rare) for _ in range(6000)), "bb")]  # over 20,000 characters
    rows += [(9200, rows[0][1], "aa")] * 1500  # copies
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    monkeypatch.setattr(langid, "LEXICON", 400)
    monkeypatch.setattr(langid, "FIT_DOCS", 400)
    monkeypatch.setattr(langid, "LEAST_WORDS", 100)
    totals = {"aa": 4000, "bb": 7}
    spans = langid.sample_spans(docs, totals).collect()
    assert len({r.key for r in spans if r.lang == "bb"}) == 7 and sum(r.lang == "bb" for r in spans) == 6 * 2 + 188
    assert 150 < len({r.key for r in spans if r.lang == "aa"}) < 350
    words = langid.lexicon_counts(docs, 200).collect()
    assert {r.word for r in words} >= set(rare) and len(words) < 500
    got = {r.doc_id: r.lang_pred for r in langid.identify(docs).collect()}
    assert {v for i, v in got.items() if 9000 <= i <= 9100} == {"bb"}
    assert sum(got[i] == "aa" for i in range(4000)) > 3960


def test_quality_fit_with_a_repeated_id(spark, monkeypatch):
    rng = random.Random(15)
    monkeypatch.setattr(quality, "FIT_DOCS", 40)
    junk = ["BUY NOW !!! $$$ ***", "| | | # # # |", "CLICK HERE !!! <<< >>>"]

    def text(good, odd):
        lines = [" ".join(rng.choice(["wort", "haus", "und", "mit", "baum", "weg"]) + str(rng.randrange(50))
                          for _ in range(12)) for _ in range(6)]
        return "\n".join(lines + [rng.choice(junk) for _ in range(odd if good else 12)])

    rows = [(i, text(i % 2 == 0, 30 if i % 100 == 10 else 0), 1 - i % 2) for i in range(2000)]
    labels = spark.createDataFrame([(i, q) for i, _, q in rows], "doc_id long, quality int")
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(0, rows[0][1])] * 3000,
                                 "doc_id long, text string").repartition(3)
    some = labels.filter("doc_id < 40")
    assert quality.fit_from(docs, some).w.any()  # the copies of one id push nobody out
    out = [r for r in quality.assess(docs, labels).collect() if r.doc_id % 2 == 0 and not r.base_failed]
    lost = {r.doc_id for r in out if not r.kept}
    assert len(lost) <= 0.002 * 1000  # a fiftieth of the good documents is odd, most of them not in the fit
    assert {r.doc_id for r in quality.keep_good(docs, labels).collect() if r.doc_id % 2 == 0} == \
        {r.doc_id for r in out if r.kept}


def test_obfuscated_personal_data_is_added(spark):
    rng = random.Random(16)
    words = "the cat sat on a mat and then it went home to eat some food with us".split()

    def prose():
        return " ".join(rng.choice(words) for _ in range(8))

    def digits(n):
        return "".join(rng.choice("123456789") for _ in range(n))

    def mail():
        return f"{rng.choice(words)}.{rng.choice(words)}", f"{rng.choice(words)}.example.com"

    rows = []
    for i in range(600):
        a, b = mail()
        rows.append(f"{prose()} {a}@{b} {prose()} +1 ({digits(3)}) {digits(3)}-{digits(4)} {prose()} {digits(6)} {prose()}")
    a, b = mail()
    planted = [f"{prose()} {a} [at] {b.replace('.', ' [dot] ')} {prose()}", f"{prose()} {a}(at){b} {prose()}",
               f"{prose()} ({digits(3)}) {digits(3)}-{digits(4)} {prose()}"]
    clean = [f"{prose()} 12.345.678 {prose()}", f"{prose()} 234 567 891 {prose()}", f"{prose()} 2010 2011 2012 {prose()}",
             f"{prose()} (at) 250.50 {prose()}", f"{prose()} 4821 {prose()}"]
    texts = rows + planted + clean
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in pii.detect(docs).collect()}
    assert [got[600 + i].n_added for i in range(3)] == [1, 1, 1]
    assert [got[603 + i].n_added for i in range(5)] == [0] * 5
    assert sum(got[i].n_added for i in range(600)) == 0


def test_lanes_of_a_task_end_together():
    rng = np.random.default_rng(15)
    docs = [rng.integers(0, 99, n) for n in (8000, *rng.integers(1, 2000, 500).tolist())]
    (group, n), = lm_score.even(iter(docs))
    assert sorted(map(len, group)) == sorted(map(len, docs))
    full = [(tgt >= 0).mean() for tgt, _ in lm_score.blocks(group, n, 256)]
    assert np.mean(full) > 0.9  # with as many lanes as there may be, the last blocks have few documents left


def test_equal_ids_are_summed():
    rng = np.random.default_rng(16)
    ids, rows = rng.zipf(1.3, 700) % 90, rng.normal(size=(700, 5))
    sums, found = lm_score._sum_by(ids, rows)
    assert found.tolist() == sorted(set(ids.tolist()))
    assert np.allclose(sums, [rows[ids == i].sum(axis=0) for i in found])


def test_training_reads_the_text_once(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(lm_score, "read_once", lambda *a, run=lm_score.read_once: calls.append(1) or run(*a))
    docs = spark.createDataFrame([(i, f"a b c{i}") for i in range(20)], "doc_id long, text string")
    assert lm_score.score(docs).count() == 20 and calls == [1]
