"""Periodic runs, the metric join and hard negatives against brute-force versions."""

import hashlib
import os
import random
import sys
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import corpus  # noqa: E402
from touchline.llm import hard_negatives, jaccard, license, metric_join, periodic, pieces, recompression, warc  # noqa: E402
from touchline.llm import words as word_arrays  # noqa: E402


def all_runs(w):
    found = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            start = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i - start + q >= max(12, 2 * q):
                found.setdefault((start, i - start + q), q)
    return sorted((s, n, q) for (s, n), q in found.items())


def test_runs_equal_brute_force():
    draw = random.Random(1)
    for _ in range(150):
        docs = []
        for _ in range(draw.randrange(1, 5)):
            kinds, n = draw.choice([1, 2, 3, 5, 50]), draw.choice([0, 1, 11, 12, 13, 30, 100, 260])
            w = [draw.randrange(kinds) for _ in range(n)]
            if n and draw.random() < 0.5:
                a = draw.randrange(n)
                p = 1 + (n - a) // draw.randrange(3, 11)
                w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
            docs.append(w)
        first = np.append(0, np.cumsum([len(d) for d in docs]))
        runs = periodic.runs_of(np.array([x for d in docs for x in d], dtype=np.int64), first)
        for d, w in enumerate(docs):
            own = runs.document == d
            assert list(zip(runs.start[own] - first[d], runs.length[own], runs.period[own], strict=True)) == all_runs(w)


def test_extensions_equal_plain_comparison():
    draw = np.random.default_rng(2)
    ids = np.append(np.tile(draw.integers(0, 3, 70), 6), 99)
    common = periodic.Extensions(ids)
    i, j = draw.integers(0, len(ids), (2, 500))
    i, j = i[i != j], j[i != j]
    plain = [next(k for k in range(len(ids)) if max(a, b) + k >= len(ids) or ids[a + k] != ids[b + k]) for a, b in zip(i, j, strict=True)]
    assert common(i, j).tolist() == plain and common.suffixes is not None


def runs_row(doc_id, text):
    w = corpus.words(text)
    n = len(w)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = all_runs(w)
    best = min(((-n, s, q) for s, n, q in runs), default=None)
    longest = (None,) * 4 if best is None else (best[1], -best[0], best[2], 1000 * -best[0] // best[2])
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()
    kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
    return (doc_id, len(runs), *longest, hashlib.sha256(lines).hexdigest(), hashlib.sha256(kept).hexdigest())


RUN_COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_run_digests_equal_brute_force(spark):
    planted = [i for i in range(400) if zlib.crc32(str(i).encode()) % 10 == 0]
    assert len(planted) > 20
    draw = random.Random(4)
    rows = [(i, " ".join(f"é{draw.randrange(50)}" for _ in range(draw.choice([1, 5, 40, 300]))), "en", "a") for i in planted]
    rows += [r for r in corpus.ROWS if r[1] is None or len(r[1]) < 20_000] + [(planted[0], None, "en", "a"), (planted[1], " ", "en", "a")]
    got = periodic.digests(corpus.frame(spark, rows)).select(*RUN_COLUMNS).collect()
    assert corpus.in_order(tuple(r) for r in got) == corpus.in_order(runs_row(*r[:2]) for r in rows)
    assert periodic.digests(corpus.frame(spark, [])).collect() == []


def test_a_long_monotonous_text_is_one_run():
    words = next(word_arrays.in_chunks(pa.array(["x " * 60_000])))
    runs = periodic.runs_of(words.distinct()[1], words.first)
    assert [tuple(map(int, c)) for c in zip(*runs, strict=True)] == [(0, 0, 60_000, 1)]


def thue_morse():
    one = "ab"
    while len(one) < 1024:
        one += one.translate(str.maketrans("ab", "ba"))
    return one, one.translate(str.maketrans("ab", "ba"))


def test_words_that_meet_under_polynomials_are_told_apart(spark):
    one, other = thue_morse()
    words = next(word_arrays.in_chunks(pa.array([f"{one} {other} {one}"])))
    hashes = words.hashes()
    assert hashes[0] == hashes[2] != hashes[1]
    docs = corpus.frame(spark, [(1, one, "en", "a"), (2, other, "en", "a"), (3, f"{one} " * 20, "en", "a"), (4, f"{other} " * 20, "en", "a")])
    assert {tuple(r) for r in jaccard.grouped(docs).select("doc_id", "component_id").collect()} == {(i, i) for i in range(1, 5)}
    assert {r.n_removed for r in recompression.digests(docs).collect()} == {0}
    assert all(r.round_trip for r in pieces.round_trips(docs).collect())
    assert len({r.ids_sha256 for r in pieces.round_trips(docs).collect()}) == 4


def test_words_with_equal_hashes_are_compared_by_bytes(monkeypatch):
    text = "aa bb aa ccc bb d"
    words = next(word_arrays.in_chunks(pa.array([text])))
    monkeypatch.setattr(word_arrays.Words, "hashes", lambda self, lower=False: np.zeros(len(self.starts), dtype=np.uint64))
    sample, which = words.distinct()
    named = text.split()
    assert [named[sample[w]] for w in which] == named and len(set(which.tolist())) == 4


VECTORS = "vec_id long, label int, embedding array<float>, grp string, digest string, node long"


def vectors_of(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash", 3) for r in rows], VECTORS)


def some_vectors():
    draw = np.random.default_rng(3)
    rows = []
    for _ in range(150):
        base = draw.normal(size=8)
        for _ in range(draw.integers(1, 4)):
            rows.append((len(rows), int(draw.choice([1, 1, 1, 2, 3])), (base + draw.normal(size=8) * draw.choice([0, 0.2, 0.5])).astype(np.float32).tolist()))
    odd = [[1.0] * 8, [2.0] * 8, None, [0.0] * 8, [float("nan")] + [1.0] * 7, [None] + [1.0] * 7, [], [1.0, 1.0], [1.0, 1.0], [float("inf")] * 8]
    rows += [(9001 + i, 1, v) for i, v in enumerate(odd)] + [(None, 1, [1.0] * 8), (9020, None, [1.0] * 8), rows[0], rows[0]]
    return rows


def sound(vector):
    return bool(vector) and None not in vector and bool(np.isfinite(vector).all())


def near_rows(rows, cosine=0.93):
    known = {(i, label, tuple(v)) for i, label, v in rows if label is not None and sound(v) and np.any(v)}
    known = sorted(known, key=repr)
    unit = [np.array(v, float) / np.linalg.norm(v) for _, _, v in known]
    group, links = list(range(len(known))), [0] * len(known)
    for i in range(len(known)):
        for j in range(len(known)):
            if i != j and known[i][1] == known[j][1] and len(unit[i]) == len(unit[j]) and float(unit[i] @ unit[j]) >= cosine:
                links[i] += 1
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    found = {}
    for k, row in enumerate(known):
        low = min((known[m][0] for m in range(len(known)) if group[m] == group[k] and known[m][0] is not None), default=None)
        found[row] = (row[0], links[k], low, row[0] == low)
    return [found.get((i, label, tuple(v or [])), (i, 0, i, True)) for i, label, v in rows]


@pytest.mark.parametrize("sizes", [{}, {"per_pivot": 2, "slab": 16, "chunk": 100}])
def test_near_vectors_equal_brute_force(spark, sizes):
    rows = some_vectors()
    got = metric_join.near_vectors(vectors_of(spark, rows), **sizes).collect()
    assert corpus.in_order(tuple(r) for r in got) == corpus.in_order(near_rows(rows))


def test_no_vectors(spark):
    assert metric_join.near_vectors(vectors_of(spark, [])).collect() == []
    assert hard_negatives.mined(hard_negatives.relabelled(vectors_of(spark, []))).collect() == []


def test_cells_hold_all_partners():
    draw = np.random.default_rng(5)
    points = draw.normal(size=(400, 3))
    points /= np.linalg.norm(points, axis=1)[:, None]
    home, guest = metric_join.cells_of(points, points[:12], 0.93)
    for i, j in np.argwhere(points @ points.T >= 0.93).tolist():
        assert home[i] == home[j] or guest[i, home[j]] and guest[j, home[i]]
    assert guest.mean() < 0.5


def hard_rows(rows):
    known = sorted({(i, (label + 1) % 10 if i % 7 == 0 else label, tuple(np.floor(256 * np.float64(v)).astype(int).tolist()))
                    for i, label, v in rows if i is not None and label is not None and sound(v)})
    found = []
    for anchor, own, a in known:
        if anchor % 50:
            continue
        scores = sorted((-sum(x * y for x, y in zip(a, v, strict=True)), i, label) for i, label, v in known if len(v) == len(a))
        for s, positive, _ in [x for x in scores if x[2] == own and x[1] != anchor][:5]:
            hard = [x for x in scores if x[2] != own and 50 * -s <= 100 * -x[0] <= 95 * -s][:3]
            found += [(anchor, positive, rank, x[1], -s, -x[0]) for rank, x in enumerate(hard, 1)]
    return found


@pytest.mark.parametrize("tree", [8192, 40])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, tree):
    monkeypatch.setattr(hard_negatives, "LEAF", 8)
    rows = some_vectors() + [(350, 1, [0.5] * 8), (400, 1, [0.5] * 8), (401, 2, [0.25] * 8), (402, 3, [0.25] * 8)]
    got = hard_negatives.mined(hard_negatives.relabelled(vectors_of(spark, rows)), tree=tree).collect()
    want = hard_rows(rows)
    assert want and sorted(tuple(r) for r in got) == sorted(want)


def test_trees_are_packed_and_prune():
    draw = np.random.default_rng(6)
    labels, vectors = np.repeat([0, 1], 500), np.concatenate([draw.normal(5, 1, (500, 2)), draw.normal(-5, 1, (500, 2))])
    order, leaf = hard_negatives.packed(labels, vectors, 50)
    assert sorted(order.tolist()) == list(range(1000)) and np.bincount(leaf).max() <= 50
    tree = hard_negatives.Tree(leaf, order, labels[order], vectors[order])
    met = []
    block = hard_negatives.Block(np.array([-1]), np.array([1]), np.array([[1.0, 1.0]]), np.array([[-np.inf]]), np.array([[np.inf]]), np.array([[-np.inf]]), 3)
    take = block.take
    block.take = lambda rows, scores, *rest: (met.append(scores.shape[1]), take(rows, scores, *rest))
    tree.search(block, 3, same=False)
    scores = vectors[:500].sum(axis=1)
    assert block.found[0, 0].tolist() == np.argsort(-scores, kind="stable")[:3].tolist() and sum(met) < 300


@pytest.mark.parametrize("piece", ["<title>", "<a ", "<script", "<a href=", "<a href='", "<!--", "<p ", "</"])
def test_unclosed_markup_takes_time_in_proportion(piece):
    page = piece * (1_000_000 // len(piece))
    start = time.perf_counter()
    warc.plain_text(page), warc.title_of(page), warc.outlinks(page)
    assert time.perf_counter() - start < 5


@pytest.mark.parametrize("piece", ["cc by ", "all rights reserved ", "SPDX-License-Identifier: MIT OR ", "SPDX-License-Identifier: ("])
def test_many_notices_take_time_in_proportion(piece):
    text = piece * (1_000_000 // len(piece))
    start = time.perf_counter()
    found = license.scanned(text, license.automaton())
    assert time.perf_counter() - start < 10
    if piece == "all rights reserved ":
        assert found[1:4] == (50_000, 0, 3 * 49_999)


def test_crowded_buckets_equal_brute_force(spark, monkeypatch):
    # No families, small blocks, and every bucket of three nodes compared by bitmaps.
    for name, value in {"CROWDED": 2, "FAMILY": 9.0, "WIDE": 8}.items():
        monkeypatch.setattr(jaccard, name, value)
    draw = random.Random(6)
    base = [[f"v{draw.randrange(300)}" for _ in range(n)] for n in (9, 40, 120)]
    rows = [(i, " ".join(w if draw.random() > 0.02 else f"u{draw.randrange(300)}" for w in base[i % 3]), "en", "s") for i in range(60)]
    got = jaccard.grouped(corpus.frame(spark, rows)).select("doc_id", "n_shingles", "component_id").collect()
    assert corpus.in_order(tuple(r) for r in got) == corpus.in_order(corpus.near_components(rows))


def test_responses_without_headers_date_or_payload(spark):
    rows = [(1, "http://a/", None, None, "<p>x</p>", "clash"), (None, None, "2020-01-01T00:00:00Z", "HTTP/1.1 200 OK\r\nX: y\r\n", None, "clash")]
    crawl = spark.createDataFrame(rows, "page_id long, target_uri string, date string, http_head string, payload string, record_type string")
    found = warc.derivatives(crawl).collect()
    heads = [dict(warc.parsed(bytes(r.record)).headers) for r in found]
    assert [h["WARC-Date"] for h in heads] == [warc.DATE] * 2 + ["2020-01-01T00:00:00Z"] * 2
    assert [r.page_id for r in found] == [1, 1, None, None] and found[2].content_length == 0
    assert warc.derivatives(crawl.limit(0)).collect() == []
