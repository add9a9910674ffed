"""The training-data operators against brute force and public libraries, with
nulls, empty and long texts, repeated rows, empty tables and extra columns."""

import collections
import hashlib
import io
import itertools
import json
import math
import os
import re
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from microblog.llm import blockjoin, bpe, kdtree, neardup, ngrams, packing, quality, separators, tokens, toxicity, warc
from microblog.llm.common import prepare

DOCS = "doc_id BIGINT, text STRING, lang STRING, ids STRING, n BIGINT, x STRING, learn STRING"
WORDS = "the of and to in is was for on that with as it be by at from this have or".split()


def doc(i, text):
    return (i, text, "en", "clash", 7, "clash", "clash")


def sentence(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join(f"{WORDS[a]}{b}" for a, b in zip(rng.integers(len(WORDS), size=n), rng.integers(50, size=n)))


TEXTS = [None, "", "   ", "Hello, world's  end\n\n it's 123 naïve 漢字 😀", "a" * 3000, sentence(1, 40_000), "same text here", "same text here", "<|endoftext|> x"]


@pytest.fixture(scope="module")
def docs(spark):
    prepare(spark)
    rows = [doc(i, t) for i, t in enumerate(TEXTS)] + [doc(None, "no id"), doc(3, "id three again")]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def texts_of(frame):
    return [(r.doc_id, r.text or "") for r in frame.collect()]


def test_bpe_equals_tiktoken_and_decodes(docs, none):
    import tiktoken

    path = P.path("byte_bpe_multi_50k.tiktoken")
    lib = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.parse_ranks(bpe.read_ranks(path)), special_tokens={})
    want = sorted((str(i), lib.encode_ordinary(t)) for i, t in texts_of(docs))
    ids = bpe.encode(docs, path, P.PATTERN)
    assert sorted((str(r.doc_id), list(r.ids)) for r in ids.collect()) == want
    back = bpe.decode(ids, path, P.PATTERN)
    assert sorted((str(r.doc_id), bytes(r.bytes)) for r in back.collect()) == sorted((str(i), t.encode()) for i, t in texts_of(docs))
    got = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.digests(docs, path, P.PATTERN).collect()}
    assert got == {(i, len(x), hashlib.sha256(",".join(map(str, x)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())
                   for i, t in texts_of(docs) for x in [lib.encode_ordinary(t)]}
    assert bpe.digests(none, path, P.PATTERN).count() == 0


def test_merge_replay_orders_merges_like_the_greedy_rule():
    ranks = {bytes([b]): b for b in range(256)} | {b"aa": 256, b"ab": 300, b"abc": 260, b"bc": 310, b"aaa": 270}
    replay = bpe.MergeReplay(range(256), bpe.pairs_of(ranks))
    rng = np.random.default_rng(0)
    words = [bytes(rng.choice(list(b"abc"), size=n)) for n in rng.integers(1, 14, size=400)]
    for w, got in zip(words, replay(words)):
        assert np.frombuffer(got, "<u4").tolist() == replay._alone(w)


def library(texts, plain=True):
    """``plain``: added tokens are text like any other."""
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    tok.encode_special_tokens = plain
    return [e.ids for e in tok.encode_batch(texts, add_special_tokens=False)]


def test_both_word_encoders_equal_the_library():
    data = tokens.read_tokenizer(P.path("byte_bpe_50k.json"))
    words = [" the", "the", " ", "\n", "  ", "'s", " naïve", "漢字", "😀", " 123", "...", "a" * 300]
    want = library(words)
    assert [np.frombuffer(x, "<u4").tolist() for x in tokens.LibraryWords(data)(words)] == want
    assert [np.frombuffer(x, "<u4").tolist() for x in tokens.replay_of(data)([w.encode() for w in words])] == want
    assert tokens.replay_of(json.dumps(json.loads(data) | {"normalizer": {"type": "Lowercase"}})) is None


def test_packing_cuts_whole_documents_into_powers_of_two(docs, none):
    out = packing.pack(docs, P.path("byte_bpe_50k.json"), P.PATTERN).collect()
    assert len({r.sequence_id for r in out}) == len(out) and {r.offset for r in out} == {0}
    assert all(r.length & (r.length - 1) == 0 and r.length <= 1024 and r.length == len(r.ids) == 1 << r.bucket for r in out)
    assert all(r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in out)
    by = collections.defaultdict(list)
    for r in sorted(out, key=lambda r: r.sequence_id):
        by[r.doc_id].append(r)
    for i, ids in zip((i for i, _ in texts_of(docs)), library([t for _, t in texts_of(docs)], plain=False)):
        if i != 3:  # two rows have this id
            assert [x for r in by[i] for x in r.ids] == ids + [0] and {r.doc_tokens for r in by[i]} == {len(ids) + 1}
    assert packing.piece_lengths(2500) == [1024, 1024, 256, 128, 64, 4] and packing.piece_lengths(0) == []
    assert packing.pack(none, P.path("byte_bpe_50k.json"), P.PATTERN).count() == 0


def test_packing_takes_added_tokens_as_the_library_does(spark):
    prepare(spark)
    texts = ["hi <|endoftext|> x", "<|endoftext|>", "<|endoftext|><|endoftext|>", "a<|endoftext|>b  <|endoftext|>\n", "<|endoftext|", "plain text"]
    frame = spark.createDataFrame([doc(i, t) for i, t in enumerate(texts)], DOCS)
    got = collections.defaultdict(list)
    for r in sorted(packing.pack(frame, P.path("byte_bpe_50k.json"), P.PATTERN).collect(), key=lambda r: (r.doc_id, r.start)):
        got[r.doc_id] += r.ids
    assert [got[i] for i in range(len(texts))] == [x + [0] for x in library(texts, plain=False)]
    assert got[0] == [5303, 220, 50256, 2124, 0]


def test_packing_writes_a_folder_per_length(docs, spark, tmp_path):
    packing.write_buckets(packing.pack(docs, P.path("byte_bpe_50k.json"), P.PATTERN), str(tmp_path / "b"))
    back = spark.read.parquet(str(tmp_path / "b"))
    assert back.where(F.size("ids") != F.expr("1 << bucket")).count() == 0 and back.count() > 10


def test_separator_scan_counts_documents(docs, none):
    out = separators.document_counts(docs, P.path("byte_bpe_50k.json"), P.PATTERN, 50256)
    want = sorted((str(i), len(x)) for (i, _), x in zip(texts_of(docs), library([t for _, t in texts_of(docs)])))
    assert sorted((str(r.doc_id), r.n_tokens) for r in out.collect()) == want
    assert separators.document_counts(none, P.path("byte_bpe_50k.json"), P.PATTERN, 50256).count() == 0


@pytest.mark.parametrize("ids", [[], [9], [1, 2, 9, 9, 3, 4, 5, 6, 7, 8, 1, 9, 2], [1] * 25, [9] * 7])
@pytest.mark.parametrize("width", [2, 4])
def test_separator_scan_stitches_blocks(spark, tmp_path, ids, width):
    prepare(spark)
    f = tmp_path / "t.bin"
    f.write_bytes(np.array(ids, f"<u{width}").tobytes())
    got = separators.scan(spark.createDataFrame([(str(f), width * len(ids))], "file STRING, bytes BIGINT"), 9, width, block_ids=4)
    want, start = [], 0
    for at, x in enumerate(ids):
        if x == 9:
            want.append((len(want), start, at - start, True))
            start = at + 1
    if start < len(ids):
        want.append((len(want), start, len(ids) - start, False))
    assert sorted((r.ordinal, r.start, r.n_tokens, r.ended) for r in got.collect()) == want


PAGES = "page_id BIGINT, url STRING, html STRING, sha1 STRING, newest BIGINT"


def test_warc_round_trip(spark, tmp_path):
    prepare(spark)
    big, long = "é" * 600, "x" * 300_000
    rows = [(1, "http://a/", big), (2, None, big), (5, "http://b/ c", big), (5, "http://b2/", big), (3, "u", "small"), (4, "u", "small"),
            (6, "u", None), (7, "u", ""), (None, "u", big), (None, "u", long), (8, "u", "line\r\n\r\nend")]
    pages = spark.createDataFrame([(*r, "clash", 1) for r in rows], PAGES)
    archives = warc.write(pages, str(tmp_path / "w"))
    got = sorted(((r.page_id or -1, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.read(archives).collect()), key=str)
    want = []
    for page, _, html in rows:
        body = (html or "").encode()
        ref = 5 if html == big and page != 5 else None
        want.append((page or -1, len(body), hashlib.sha1(body).hexdigest(), "revisit" if ref else "response", ref))
    assert got == sorted(want, key=str)
    payloads = {r.page_id: bytes(r.payload) for r in warc.read(archives).where("record_type = 'response' and page_id is not null").collect()}
    assert payloads[8] == b"line\r\n\r\nend" and payloads[6] == b"" and payloads[5] == big.encode()
    assert warc.read(warc.write(pages.limit(0), str(tmp_path / "e"))).count() == 0


def test_warc_reader_refuses_damage():
    good = warc.record(1, "u", b"payload" * 300, None)
    assert [r["payload"] for r in warc.records(io.BytesIO(good + warc.record(2, "u", b"two", None)))] == [b"payload" * 300, b"two"]
    plain = zlib.decompress(good, 31)
    for bad in (plain.replace(b"payload", b"pAyload", 1), plain[:-4], plain.replace(b"WARC/1.1", b"NONE/1.1")):
        pack = zlib.compressobj(1, zlib.DEFLATED, 31)
        with pytest.raises(ValueError):
            list(warc.records(io.BytesIO(pack.compress(bad) + pack.flush())))
    with pytest.raises(ValueError):
        list(warc.records(io.BytesIO(good[:-20])))


def labelled(spark, n, bad, column):
    rows, labels = [], []
    for i in range(n):
        text = sentence(i, 30 + i % 40)
        if i % 4 == 0:
            text = bad(text)
        rows.append(doc(i, text))
        labels.append((i, (0 if i % 4 == 0 else 1) if column == "quality" else (1 if i % 4 == 0 else 0)))
    rows += [doc(None, "no id"), doc(9001, None), doc(9002, ""), doc(9003, sentence(3, 20_000)), rows[1]]
    return spark.createDataFrame(rows, DOCS), spark.createDataFrame([*labels, (9003, None), (None, 1)], f"doc_id BIGINT, {column} INT")


def held_out_accuracy(out, labels, column, cut):
    known = {r.doc_id: r[column] for r in labels.collect()}
    held = [(r.score >= cut) == bool(known[r.doc_id]) for r in out if r.doc_id is not None and known.get(r.doc_id) is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    return sum(held) / len(held)


def learn():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0


def test_quality_separates_held_out_texts(spark, none):
    prepare(spark)
    frame, labels = labelled(spark, 300, lambda t: t.replace(" ", "$$$ "), "quality")
    out = quality.scored(frame, labels, learn()).collect()
    assert len(out) == 305 and all(0 <= r.score <= 1 for r in out)
    assert held_out_accuracy(out, labels, "quality", quality.CUT) > 0.97
    assert quality.scored(none, labels, learn()).count() == 0
    assert {r.score for r in quality.scored(frame, labels.where("quality = 1"), learn()).collect()} == {0.5}


def test_quality_weights_minimise_the_loss():
    """Newton's solution against slow gradient descent on the same pairs."""
    rng = np.random.default_rng(4)
    good, bad = rng.normal(0.5, 1, size=(80, 4)), rng.normal(0, 1, size=(60, 4))
    mean, scale, w = quality.fit(good, bad, pairs=400, ridge=0.05)
    draw = np.random.default_rng(1)
    d = (good[draw.integers(80, size=400)] - bad[draw.integers(60, size=400)]) / scale
    slow = np.zeros(4)
    for _ in range(4000):
        slow -= 0.2 * (d.T @ (1 / (1 + np.exp(-d @ slow)) - 1) / 400 + 0.05 * slow)
    assert np.abs(w - slow).max() < 1e-6 and np.allclose(mean, np.concatenate([good, bad]).mean(axis=0))


def test_quality_ties_at_the_threshold(spark):
    prepare(spark)
    rows = [(i, "one good text of words" if i % 3 else "$$$ bad ### text") for i in range(60)]
    frame = spark.createDataFrame([doc(*r) for r in rows], DOCS)
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(60)], "doc_id BIGINT, quality INT")
    out = {r.doc_id: r.score for r in quality.scored(frame, labels, F.lit(True)).collect()}
    assert all((out[i] >= quality.CUT) == (i % 3 > 0) for i in out)  # all bad ones lie at the quantile
    same = spark.createDataFrame([doc(i, "the same text") for i in range(60)], DOCS)
    assert all(r.score >= quality.CUT for r in quality.scored(same, labels, F.lit(True)).collect())


def test_toxicity_separates_held_out_texts(spark, none):
    prepare(spark)
    frame, labels = labelled(spark, 400, lambda t: t.replace(" ", " vileword ", 3), "toxic")
    out = toxicity.scored(frame, labels, learn()).collect()
    assert len(out) == 405 and all(0 <= r.score <= 1 for r in out)
    assert held_out_accuracy(out, labels, "toxic", toxicity.CUT) > 0.95
    assert {r.score for r in out if r.doc_id in (9001, 9002)} == {0.0}
    assert toxicity.scored(none, labels, learn()).count() == 0
    assert {r.score for r in toxicity.scored(frame, labels.where("toxic = 1"), learn()).collect()} == {0.0}


def test_toxicity_reads_all_windows_of_long_texts(spark):
    prepare(spark)
    rows = []
    for i in range(300):
        words = sentence(3000 + i, 448).split()
        if i % 3 == 0:
            words[130:158:2] = ["vileword"] * 14  # in windows 3 and 4 of 13; six evenly spread ones are 0, 2, 5, 7, 10 and 12
        rows.append(doc(i, " ".join(words)))
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(300)], "doc_id BIGINT, toxic INT")
    out = toxicity.scored(spark.createDataFrame(rows, DOCS), labels, learn()).collect()
    assert held_out_accuracy(out, labels, "toxic", toxicity.CUT) > 0.95


def test_windows_cover_every_word():
    for n in (0, 1, 63, 64, 65, 96, 97, 500):
        wins = toxicity.windows(np.arange(n))
        assert set(wins.ravel().tolist()) - {-1} == set(range(n))


def test_network_equals_a_plain_loop():
    """One unit, one word and one step at a time, from the definition."""
    words, net = toxicity.Words(), toxicity.Network(5)
    rng = np.random.default_rng(1)
    net.p = {k: rng.standard_normal(v.shape).astype(np.float32) * 0.3 for k, v in net.p.items()}
    texts = [sentence(i, n).split() + ["x" * 300] for i, n in ((1, 7), (2, 63), (3, 1))]
    wins = np.concatenate([toxicity.windows(np.array([words[w] for w in t])) for t in texts])
    got = net.logits(net.inputs(words.rows()), wins)
    p, H = {k: v.astype(np.float64) for k, v in net.p.items()}, toxicity.HIDDEN
    sig = lambda x: 1 / (1 + math.exp(-x))

    def gram_row(gram):
        h = len(gram)
        for c in gram:
            h = ((h ^ ord(c)) * 0x9E3779B1) % 2**32
            h ^= h >> 15
        return h % toxicity.CHAR_ROWS

    def vector(word):
        low = "<" + (word.strip(toxicity._MARKS) or word) + ">"
        grams = [low[i:i + n] for n in toxicity.GRAMS for i in range(len(low) - n + 1)]
        chars = sum(p["char"][gram_row(g)] for g in grams) / math.sqrt(len(grams))
        return [*p["word"][__import__("xxhash").xxh32_intdigest(low.encode()) % toxicity.WORD_ROWS], *chars]

    def states(d, xs):
        h, out = [0.0] * H, []
        for x in xs if d == "f" else xs[::-1]:
            gate = [sum(a * w for a, w in zip(x, p["W" + d][:, j])) + p["c" + d][j] for j in range(3 * H)]
            back = [sum(a * w for a, w in zip(h, p["U" + d][:, j])) for j in range(3 * H)]
            z, r = ([sig(gate[j + o] + back[j + o]) for j in range(H)] for o in (0, H))
            n = [math.tanh(gate[j + 2 * H] + r[j] * back[j + 2 * H]) for j in range(H)]
            h = [(1 - z[j]) * n[j] + z[j] * h[j] for j in range(H)]
            out.append(h)
        return out if d == "f" else out[::-1]

    for text, z in zip(texts, got):
        for start in toxicity.window_starts(len(text)):
            xs = [vector(w) for w in text[start:start + toxicity.WINDOW]]
            both = [f + b for f, b in zip(states("f", xs), states("b", xs))]
            e = [math.exp(sum(math.tanh(sum(s * a for s, a in zip(st, p["A"][:, j]))) * p["v"][j] for j in range(H))) for st in both]
            pooled = [sum(w * st[j] for w, st in zip(e, both)) / sum(e) for j in range(2 * H)]
            want = sum(x * o for x, o in zip(pooled, p["o"])) + p["b"][0]
            assert abs(z - want) < 1e-3


def test_toxicity_sample_is_bounded_by_rows_and_words_are_whole(spark):
    prepare(spark)
    long = "harmless" * 40
    rows = [(1, f"text number {i}") for i in range(500)] + [(i, sentence(i, 20) + " " + long + ("vile" if i % 2 else "mild")) for i in range(2, 120)]
    frame = spark.createDataFrame([doc(*r) for r in rows], DOCS)
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 120)], "doc_id BIGINT, toxic INT")
    sampled, there = toxicity._sampled(frame, labels, F.lit(True), "toxic", "doc_id", "text", 30)
    assert sampled.count() == 60 and there == {0: 59, 1: 60}
    a, b = toxicity.Words(), toxicity.Words()
    a[long + "vile"], b[long + "mild"]
    assert a.rows().word[0] != b.rows().word[0] and set(a.rows().grams) != set(b.rows().grams)
    out = toxicity.scored(frame, labels, F.lit(True)).where("doc_id > 1").collect()
    assert np.mean([(r.score >= 0.5) == bool(r.doc_id % 2) for r in out]) > 0.9  # by a word's last letters alone


def test_network_gradients_equal_finite_differences():
    words, net = toxicity.Words(), toxicity.Network(3)
    wins = np.array([[words[w] for w in sentence(i, toxicity.WINDOW - 5).split()] + [-1] * 5 for i in range(3)])
    y, weight, known = np.array([1, 0, 1], np.float32), np.ones(3, np.float32), words.rows()

    def loss():
        z = net.logits(net.inputs(known), wins).astype(np.float64)
        return np.mean(np.log1p(np.exp(-np.where(y == 1, z, -z))))

    for k, g in net.gradients(known, wins, y, weight).items():
        at = np.unravel_index(np.argmax(np.abs(g)), g.shape)
        old = net.p[k][at]
        net.p[k][at] = old + 1e-2
        up = loss()
        net.p[k][at] = old - 1e-2
        down = loss()
        net.p[k][at] = old
        assert abs((up - down) / 2e-2 - g[at]) < 0.05 * abs(g[at]) + 1e-4, k


VECS = "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT, row STRING, score DOUBLE"


def vectors(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.standard_normal(8).round(2).tolist()) for i in range(300)]
    rows += [(400 + i, rows[3][1]) for i in range(60)] + [(100, rows[3][1]), (None, rows[1][1]), (500, None), (501, [float("nan")] * 8), (502, [float("inf")] * 8), (503, [None] * 8), (504, [0.0] * 8), (505, [1.0]), (506, [])]
    rows += [(600 + i, rng.standard_normal(3).round(2).tolist()) for i in range(60)] + [(700, [1.0, 2.0]), (720, [0.5, 0.25]), (800, [7.0] * 5)]  # other lengths
    return rows, spark.createDataFrame([(*r, 0, "clash", 0.5) for r in rows], VECS)


def by_force(rows, divisor, k, change, zero):
    ok = [(n, i, change(np.array(v, np.float32).astype(np.float64))) for n, (i, v) in enumerate(rows)
          if i is not None and v and None not in v and np.isfinite(v).all() and (zero or any(v))]
    out = []
    for n, i, q in ok:
        if i % divisor == 0:
            near = sorted((-float((q * c).sum()), j) for m, j, c in ok if m != n and len(c) == len(q))[:k]
            out += [(i, r, j, round(-s, 9)) for r, (s, j) in enumerate(near, 1)]
    return sorted(out)


@pytest.mark.parametrize("sizes", [{}, {"group_bytes": 40 * 64, "queries": 7}])
def test_searches_equal_brute_force(spark, sizes):
    prepare(spark)
    rows, frame = vectors(spark)
    got = sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in blockjoin.search(frame, 20, 20, **sizes).collect())
    assert got == by_force(rows, 20, 20, lambda x: x, False)
    got = sorted((r.query_id, r["rank"], r.vec_id, float(r.score)) for r in kdtree.search(frame, 50, 5, **sizes).collect())
    assert got == by_force(rows, 50, 5, lambda x: np.floor(256 * x), True)
    assert blockjoin.search(frame.limit(0)).count() == 0 and kdtree.search(frame.limit(0)).count() == 0


def test_search_copies_candidates_once_a_group_of_queries(spark, monkeypatch):
    """Shuffled rows for twice and four times the input: candidates are not
    copied while the queries fit one group, and queries once a group."""
    from microblog.llm import tiles

    prepare(spark)
    found = []

    def counted(q, q_rows, vecs, holders, k):
        return iter([(0, len(q), float(len(vecs)))])

    for n in (400, 800, 1600):
        rng = np.random.default_rng(n)
        frame = spark.createDataFrame([(i, rng.standard_normal(4).tolist(), 0, "clash", 0.5) for i in range(n)], VECS)
        met = tiles.nearest(frame, 20, 10**6, counted, "double", "vec_id", "embedding", zero=True, least_pairs=4).collect()
        found.append((sum(r.vec_id for r in met), sum(r.score for r in met)))
    assert found == [(n / 20, n) for n in (400, 800, 1600)]


def test_kd_tree_skips_leaves_where_vectors_lie_in_clusters():
    rng = np.random.default_rng(3)
    centers = rng.integers(-200, 200, size=(40, 6))
    vecs = np.concatenate([c + rng.integers(-5, 6, size=(200, 6)) for c in centers]).astype(float)
    tree = kdtree.Tree(vecs, leaf=64)
    leaf = np.array([p is not None for p in tree.points])
    bounds = tree.bounds(vecs[::50])[:, leaf]
    kth = np.sort(vecs[::50] @ vecs.T, axis=1)[:, -6]
    assert (bounds >= kth[:, None]).mean() < 0.2


def test_kd_tree_boxes_are_tight_and_leaves_partition():
    vecs = np.random.default_rng(1).integers(-50, 50, size=(700, 5)).astype(float)
    tree = kdtree.Tree(vecs, leaf=16)
    leaves = np.concatenate([p for p in tree.points if p is not None])
    assert sorted(leaves.tolist()) == list(range(700))
    for node, at in enumerate(tree.points):
        if at is not None:
            assert (tree.low[node] == vecs[at].min(axis=0)).all() and (tree.high[node] == vecs[at].max(axis=0)).all()


def near_by_force(rows):
    sets = []
    for i, t in rows:
        w = [x.lower() for x in re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode())]
        sets.append(frozenset(tuple(w[j:j + 5]) for j in range(max(1, len(w) - 4))) if w else frozenset())
    top = {i: i for i, _ in rows if i is not None}

    def find(a):
        while top[a] != a:
            a = top[a]
        return a

    for a, (i, _) in enumerate(rows):
        for b, (j, _) in enumerate(rows[:a]):
            if None not in (i, j) and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = find(i), find(j)
                top[max(x, y)] = min(x, y)
    return sorted((str(i), len(s), str(find(i) if i is not None else None)) for (i, _), s in zip(rows, sets))


def test_near_duplicates_equal_brute_force(spark, none):
    prepare(spark)
    rng = np.random.default_rng(11)
    rows = []
    for base in range(12):
        words = sentence(base, 60).split()
        for _ in range(5):
            copy = list(words)
            for at in rng.integers(len(copy), size=int(rng.integers(0, 4))):
                copy[at] = f"edit{rng.integers(1000)}"
            rows.append((len(rows), " ".join(copy)))
    passage = sentence(99, 50)
    rows += [(100 + i, passage + " " + sentence(200 + i, 45)) for i in range(40)]  # share a passage, are no copies
    core = sentence(77, 80).split()
    for i in range(45):  # one large group of near copies
        copy = list(core)
        copy[int(rng.integers(80))] = f"new{i}"
        rows.append((200 + i, " ".join(copy)))
    rows += [(300, None), (301, ""), (302, "one two"), (303, "ONE  two"), (304, "one"), (None, rows[0][1]), (0, rows[0][1]),
             (400, sentence(500, 60)), (400, sentence(501, 60)), (401, sentence(501, 60)), (399, sentence(500, 60)), (402, sentence(1, 30_000)), (403, sentence(1, 30_000) + " tail")]
    frame = spark.createDataFrame([doc(i, t) for i, t in rows], DOCS)
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in neardup.near_duplicates(frame).collect())
    assert got == near_by_force(rows)
    assert neardup.near_duplicates(none).count() == 0


def test_near_copies_that_meet_in_long_lists_only(spark):
    prepare(spark)
    passage, rows = sentence(15, 169), []  # 165 of each text's 200 shingles; 25 pairs share long lists only
    for i in range(100):
        own = sentence(1000 + i, 35)
        rows += [doc(2 * i, f"{passage} {own}"), doc(2 * i + 1, f"{passage} {own} end")]
    got = neardup.near_duplicates(spark.createDataFrame(rows, DOCS)).collect()
    assert {r.doc_id: r.component_id for r in got} == {r[0]: r[0] // 2 * 2 for r in rows}


def test_near_copies_of_shared_passages_only(spark):
    prepare(spark)
    parts = [sentence(20 + i, 24) for i in range(9)]  # no text has a shingle of its own inside a part
    rows = [doc(i, " ".join(parts[j] for j in pick)) for i, pick in enumerate(itertools.combinations(range(9), 4))]
    rows += [doc(1000 + i, t + " end") for i, (_, t, *_) in enumerate(list(rows))]
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in neardup.near_duplicates(spark.createDataFrame(rows, DOCS), lists=2, short=4).collect())
    assert got == near_by_force([r[:2] for r in rows])


def test_components_of_a_long_chain(spark):
    prepare(spark)
    got = neardup.components(spark.range(30).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")))
    assert {(r.node, r.comp) for r in got.collect()} == {(i, 0) for i in range(31)}


def automaton_by_force(rows, learn, order, mu=ngrams.MU):
    """From the definition, with recursion instead of arcs."""
    toks = [[w.lower() for w in re.findall(rb"[^\x20\x09-\x0D]+", t.encode())] + [None] for _, t in rows]
    count = collections.Counter()
    for (i, _), w in zip(rows, toks):
        if learn(i):
            count.update((x,) for x in w)
            padded = [None, *w]
            count.update(tuple(padded[j:j + k]) for k in range(2, order + 1) for j in range(len(padded) - k + 1))
    n, v = sum(c for g, c in count.items() if len(g) == 1), sum(len(g) == 1 for g in count)

    def chance(h, w):
        if not h:
            return (count[w,] + 0.5) / (n + 0.5 * (v + 1))
        lower, m = chance(h[1:], w), mu[min(len(h) - 1, len(mu) - 1)]
        return (count[*h, w] + m * lower) / (count[h] + m) if count[h] >= ngrams.STATE else lower

    want = []
    for (i, _), w in zip(rows, toks):
        padded = [None, *w]
        base = sum(math.log10(chance((), x)) for x in w)
        s = sum(math.log10(chance(tuple(padded[max(0, j + 1 - order + 1):j + 1]), x)) for j, x in enumerate(w))
        want.append((str(i), len(w), sum(count[x,] > 0 for x in w), n, round(base, 4), round(s, 4)))
    return sorted(want), chance, count


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_automaton_equals_brute_force(docs, none, spark, order):
    more = [doc(100 + i, " ".join(["a b c d a b", "a b c e", "b c d", "x y x y x y", "A  B\nc d"][j] for j in np.random.default_rng(i).integers(5, size=6))) for i in range(40)]
    frame = docs.unionByName(spark.createDataFrame(more, DOCS))
    got = ngrams.score(frame, F.col("doc_id") % 5 != 0, order=order, shards=3).collect()
    want, _, _ = automaton_by_force(texts_of(frame), lambda i: i is not None and i % 5 != 0, order)
    assert sorted((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4), round(r.score, 4)) for r in got) == want
    assert ngrams.score(none, F.col("doc_id") != 5, order=order).count() == 0


def test_weights_of_a_state_sum_to_one():
    rows = [(i, " ".join("abcab"[j:j + 3])) for i, j in enumerate([0, 1, 2, 0, 1, 2, 2])]
    _, chance, count = automaton_by_force(rows, lambda i: True, 3)
    words = [g[0] for g in count if len(g) == 1]
    for h in [(), *(g for g in count if len(g) < 3 and g[-1] is not None or g == (None,))]:
        seen = sum(chance(h, w) for w in words)
        assert abs(seen + chance(h, b"unheard") - 1) < 1e-9


def test_longer_contexts_tell_repeated_texts(spark):
    """A held-out text whose copy was learnt from scores far above its like."""
    rows = [doc(i, sentence(5000 + i, 80)) for i in range(200)]
    rows += [doc(1000 + i, rows[i][1]) for i in range(10)] + [doc(2000 + i, rows[i][1]) for i in range(10)]
    frame = spark.createDataFrame(rows, DOCS)
    out = {o: {r.doc_id: r.score / r.n_tokens for r in ngrams.score(frame, ~F.col("doc_id").between(150, 1007), order=o).collect()} for o in (2, 3)}
    for o in (2, 3):  # all of these are held out, copies of 0 to 7 were learnt from
        out[o]["gap"] = np.mean([out[o][1000 + i] for i in range(8)]) - np.mean([out[o][i] for i in range(150, 200)])
    assert out[3]["gap"] > 1.5 * out[2]["gap"] > 0


def test_pipeline_stages_keep_columns_and_drop_rows(spark, tmp_path):
    import corpus_pipeline as pipe

    prepare(spark)
    rows = [(i, sentence(i, 60), "en", "s", 1) for i in range(120)]
    rows = [(i, t.replace(" ", "$$$ ") if i % 6 == 0 else t.replace(" ", " vileword ", 4) if i % 6 == 1 else t, *r) for i, t, *r in rows]
    rows += [(1000 + i, rows[2 + 6 * i][1], "en", "s", 1) for i in range(5)] + [(None, rows[3][1], "en", "s", 1), (2000, None, None, None, None)]
    ddl = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
    spark.createDataFrame(rows, ddl).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, int(i % 6 != 0), int(i % 6 == 1)) for i in range(120)], "doc_id BIGINT, quality INT, toxic INT").write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    seen = []
    for name, stage in pipe.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == list(pipe.COLUMNS)
        seen.append([r.doc_id for r in docs.collect()])
    good, mild, single = seen
    assert not any(i is not None and i < 1000 and i % 6 == 0 for i in good)
    assert sum(i is not None and i < 1000 and i % 6 == 1 for i in mild) <= 2
    assert not any(i is not None and 1000 <= i < 1005 for i in single) and len(single) == len(set(single))
    out = pipe.run(spark, str(tmp_path)).toPandas()
    assert set(out.doc_id.dropna().astype(int)) == {i for i in single if i is not None}
    assert (out.ids.map(len) == out.length).all()
    assert (out.groupby(out.doc_id.fillna(-1)).length.sum() == out.groupby(out.doc_id.fillna(-1)).doc_tokens.first()).all()


def test_pipeline_judges_rows_not_ids(spark, tmp_path):
    """Of rows that share an id, or have none, the bad and the toxic ones go;
    texts may be empty or very long; columns may be more than those of
    documents; empty tables stay empty."""
    import corpus_pipeline as pipe

    prepare(spark)
    bad, vile = (lambda t: t.replace(" ", "$$$ ")), (lambda t: t.replace(" ", " vileword ", 4))
    rows = [(i, [bad, vile, str][i % 3](sentence(i, 60)), "en", "s", 1, "score") for i in range(180)]
    two = [(i, sentence(500 + i, 60)) for i in (0, 1, 2)] + [(2, bad(sentence(700, 60))), (2, vile(sentence(701, 60)))]
    none = [(None, sentence(800, 60)), (None, bad(sentence(801, 60))), (None, vile(sentence(802, 60)))]
    rows += [(i, t, "en", "s", 1, "score") for i, t in [*two, *none, (900, sentence(9, 30_000))]]
    ddl = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT, score STRING"
    labels = spark.createDataFrame([(i, int(i % 3 != 0), int(i % 3 == 1)) for i in range(3, 180)], "doc_id BIGINT, quality INT, toxic INT")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.createDataFrame(rows, ddl)
    good = pipe.keep_quality(spark, docs, str(tmp_path))
    mild = pipe.drop_toxic(spark, good, str(tmp_path))
    assert good.columns == mild.columns == list(pipe.COLUMNS)
    left = {(r.doc_id, r.text) for r in mild.collect()}
    assert left >= {(0, two[0][1]), (1, two[1][1]), (2, two[2][1]), none[0]}  # the long text is unlike all that was learnt from
    assert not left & {two[3], two[4], none[1], none[2], (0, rows[0][1]), (1, rows[1][1])}
    empty = docs.limit(0)
    for _, stage in pipe.STAGES:
        empty = stage(spark, empty, str(tmp_path))
        assert empty.count() == 0


def test_entry_registers_all_operators():
    import __spark_entry__ as E

    names = set(E.queries())
    assert "pipeline" in names and {int(m[1]) for n in names if (m := re.match(r"op(\d+)_", n))} == set(range(1, 14))


@pytest.mark.parametrize("name", ["op2_warc", "op6_block_matrix_join", "op9_kd_trees"])
def test_query_equals_its_sql(spark, duck_check, name):
    import __spark_entry__ as E
    from tools.oracle_check import compare

    assert os.path.exists("/root/testdata/sf0.01")
    problems, _, _ = compare(spark, duck_check, name, E.queries()[name], E.oracle_sql()[name], "/root/testdata/sf0.01")
    assert not problems, problems
