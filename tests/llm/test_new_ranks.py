"""Fast similarity sketches, the bit-sliced index and block Lanczos against brute force."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from driftwell.llm import impacts, neardup, sketches
from driftwell.llm.impacts import search
from driftwell.llm.sketches import bands_of, minhash_near_duplicates, shingle_sets
from driftwell.llm.sketches import sketches as sketch
from driftwell.llm.whitening import block_lanczos, whiten

from .test_links import union

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def same(got, expected):
    assert sorted(map(repr, got)) == sorted(map(repr, expected))


# near-dedup


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def jaccard_components(rows, percent):
    sets = [shingle_set(t) for _, t in rows]
    up = list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = top(i), top(j)
                up[max(x, y)] = min(x, y)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[top(i)] = min(least.get(top(i), d), d)
    return [(d, len(s), least.get(top(i)), least.get(top(i)) == d) for i, ((d, _), s) in enumerate(zip(rows, sets))]


def near_copies(rng):
    """Chains, stars and pairs about the threshold, short texts, and texts that share half of theirs."""
    texts = []
    for n in (5, 6, 8, 11, 19, 40, 90, 300, 900):
        base = [f"W{rng.getrandbits(30):x}" for _ in range(n + 4)]
        for cut in range(0, max(3, n // 3), max(1, n // 40)):
            texts.append(" ".join([*base[: len(base) - cut], *[f"v{rng.getrandbits(30):x}" for _ in range(cut)]]))
            texts.append(" ".join(base[cut // 2 :]))
    common = [f"c{rng.getrandbits(30):x}" for _ in range(60)]
    texts += [" ".join([*common, *[f"o{rng.getrandbits(30):x}" for _ in range(rng.choice([4, 40]))]]) for _ in range(40)]
    return texts


@pytest.mark.parametrize("chunk", [256, 3])
def test_links_match_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(neardup, "CHUNK", chunk)
    rows = list(enumerate(near_copies(random.Random(8))))
    got = minhash_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    same([tuple(r) for r in got], jaccard_components(rows, 85))


def test_near_duplicates_of_nothing(spark, empty):
    assert minhash_near_duplicates(empty).collect() == []
    rows = [(1, None), (2, ""), (None, " \n"), (2, "")]
    got = minhash_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    same([tuple(r) for r in got], [(1, 0, 1, True), (2, 0, 2, True), (2, 0, 2, True), (None, 0, None, True)])


def test_every_coordinate_fills_and_estimates():
    rng = random.Random(3)
    texts = []
    for n in (1, 2, 7, 60, 124, 500, 5000):
        base = [f"w{rng.getrandbits(40):x}" for _ in range(n + 4)]
        texts += [" ".join(base), " ".join([*base[:-1], "other"])]
    first, hashes = shingle_sets([t.encode() for t in texts], 5)
    out = sketch(first, hashes)
    assert (out != ~np.uint64(0)).all() and out.shape == (len(texts), sketches.COORDINATES)
    for i in range(0, len(texts), 2):
        a, b = (set(hashes[first[x] : first[x + 1]].tolist()) for x in (i, i + 1))
        j = len(a & b) / len(a | b)
        assert abs((out[i] == out[i + 1]).mean() - j) < 4 * math.sqrt(j * (1 - j) / sketches.COORDINATES) + 1e-9
    assert (sketch(np.array([0, 0]), hashes[:0]) == ~np.uint64(0)).all()


def test_pairs_at_the_threshold_meet():
    """3,000 isolated pairs of 0.85 or little more, of each of some sizes, share a band."""
    rng = np.random.default_rng(5)
    for n in (12, 37, 111, 740):
        extra = math.floor(n * 0.15 / 0.85 / 2)  # to each side
        size, flat = [], []
        for _ in range(3000):
            v = rng.integers(0, 1 << 63, n + 2 * extra, dtype=np.uint64)
            for part in (v[: n + extra], np.concatenate([v[:n], v[n + extra :]])):
                size.append(len(part))
                flat.append(part)
        bands = bands_of(sketch(np.concatenate([[0], np.cumsum(size)]), np.concatenate(flat)))
        assert ((bands[::2] == bands[1::2]).any(axis=1)).all()


# lexical search


def term_list(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def ranked(rows, items, k):
    docs = [(d, Counter(term_list(t))) for d, t in rows]
    docs = [(d, c, sum(c.values())) for d, c in docs if c]
    n_docs, total = len(docs), sum(n for _, _, n in docs)
    holding = Counter(t for _, c, _ in docs for t in c)
    out = []
    for item, text in items:
        scores = []
        for d, c, n in docs:
            m = 75 + 25 * n * n_docs // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holding[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 12 * m)) for t in term_list(text) if t in c)
            if score > 0:
                scores.append((-score, d is None, d or 0))
        out += [(item, i + 1, None if none else d, -s) for i, (s, none, d) in enumerate(sorted(scores)[:k])]
    return out


@pytest.mark.parametrize("docs_a_block, terms, block_bytes", [(4096, 2048, 4_000_000), (70, 5, 300)])
def test_search_matches_brute_force(spark, docs, rows, monkeypatch, docs_a_block, terms, block_bytes):
    monkeypatch.setattr(impacts, "BLOCK_DOCS", docs_a_block)
    monkeypatch.setattr(impacts, "TERMS", terms)
    rng = random.Random(2)
    texts = [r[1] for r in rows if r[1]]
    items = [(i, " ".join(rng.choice(texts).split()[:60])) for i in range(9)] + [(20, "AB ab Ab ab-ab"), (21, "ñandú 日本語 one"), (22, None), (None, "line of words"), (23, "..."), (24, "nowhere2"), (20, "AB ab Ab ab-ab"), (25, "words " * 400)]
    got = search(docs, spark.createDataFrame(items, "item_id long, text string"), k=7, block_bytes=block_bytes).collect()
    same([tuple(r) for r in got], ranked([r[:2] for r in rows], items, 7))


def test_search_of_nothing(spark, docs, empty):
    items = spark.createDataFrame([("a", "some words")], "item_id string, text string")
    assert search(empty, items).collect() == [] and search(docs, items.limit(0)).collect() == []
    assert search(empty, items).columns == ["item_id", "rank", "doc_id", "score"]


def test_ties_by_id(spark):
    rows = [(i, "same text") for i in random.Random(1).sample(range(500), 300)] + [(None, "same text")] * 3
    items = spark.createDataFrame([(1, "text of the same")], "item_id long, text string")
    got = search(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), items, k=302).orderBy("rank").collect()
    assert [r.doc_id for r in got] == [*sorted(i for i, _ in rows[:300]), None, None] and len({r.score for r in got}) == 1


def test_slices_add_and_rank():
    rng = np.random.default_rng(9)
    values = rng.integers(0, 1 << 20, (6, 4, 128))
    sums = np.zeros((0, 4, 2), dtype=np.uint64)
    for v in values:
        bits = np.packbits(((v[None] >> np.arange(20)[:, None, None]) & 1).astype(bool), axis=2, bitorder="little").view(np.uint64)
        sums = impacts.add(sums, bits)
    query, doc = np.nonzero(np.ones((4, 128)))
    assert (impacts.read(sums, query, doc).reshape(4, 128) == values.sum(axis=0)).all()
    chosen = np.unpackbits(impacts.best(sums, 5).view(np.uint8), axis=1, bitorder="little").astype(bool)
    for total, mine in zip(values.sum(axis=0), chosen):
        assert sorted(np.flatnonzero(mine)) == sorted(np.argsort(-total, kind="stable")[:5])


# whitening


def vectors():
    """Twelve dimensions of falling spread, repeated and null ids, and rows that have to go."""
    rng = np.random.default_rng(21)
    turn = np.linalg.qr(rng.standard_normal((12, 12)))[0]
    v = (rng.standard_normal((400, 12)) * 0.7 ** np.arange(12)) @ turn + 3
    rows = [(i, [float(np.float32(x)) for x in e], 1, "n", "x") for i, e in enumerate(v)]
    nan, inf = float("nan"), float("inf")
    bad = [None, [], [None] * 12, [1.0] * 11 + [None], [nan] + [0.0] * 11, [inf] * 12, [1.0] * 11 + [-inf], [1.0] * 11, [1.0] * 13, [1e30] * 12]
    return rows + [rows[3], (None, rows[4][1], None, None, None)] + [(900 + i, b, 0, None, None) for i, b in enumerate(bad)]


def check_whitening(got, rows, components=8):
    fit = [(r[0], r[1]) for r in rows if r[1] and len(r[1]) == 12 and all(x is not None and math.isfinite(x) and abs(x) < 1e9 for x in r[1])]
    x = np.array([[math.floor(1024 * c) + 100_000 for c in e] for _, e in fit], dtype=np.int64)
    n, total = len(x), x.sum(axis=0)
    centred = x - total / n
    values, directions = np.linalg.eigh(centred.T @ centred / n)
    values, directions = values[::-1], directions[:, ::-1]
    expected = centred @ directions[:, :components] / np.sqrt(values[:components])
    exact = [sum(int(d) ** 2 for d in n * row - total) for row in x]
    by_id, sign = {}, {}
    for (i, _), w, d in zip(fit, expected, exact):
        by_id.setdefault(i, []).append((d, w))
    assert Counter((r[0], r[1]) for r in got) == Counter((i, c) for i, _ in fit for c in range(1, components + 1))
    for vec_id, c, rows_, deviation, white, explained, error in got:
        d, w = min(by_id[vec_id], key=lambda p: abs(abs(p[1][c - 1]) - abs(white)))
        assert rows_ == n and deviation == d and error < 1e-9
        assert explained == pytest.approx(values[c - 1] / values.sum(), rel=1e-9)
        sign.setdefault(c, np.sign(w[c - 1] * white)) if abs(white) > 0.1 else None
    for vec_id, c, _, _, white, _, _ in got:
        assert min(abs(p[1][c - 1] * sign[c] - white) for p in by_id[vec_id]) < 1e-8


def test_whitening_in_small_blocks(spark):
    """Blocks narrower than the space: several passes."""
    frame = spark.createDataFrame(vectors(), "vec_id long, embedding array<float>, label int, n string, x string").repartition(4)
    check_whitening([tuple(r) for r in whiten(frame, components=2, block=2).collect()], vectors(), 2)


def test_lanczos_finds_equal_and_missing_values():
    rng = np.random.default_rng(3)
    turn = np.linalg.qr(rng.standard_normal((90, 90)))[0]
    for values in ([5, 5, 5, 5, 3, 2, 2, 1] + [0.5] * 30 + [0] * 52, [1] * 90, [4, 2] + [0] * 88, [0] * 90, list(np.linspace(3, 1, 90)), [1e6, 1] + [1e-3] * 88):
        a = (turn * values) @ turn.T
        got, vectors_, passes = block_lanczos(lambda q: a @ q, 90, 8)
        assert np.allclose(got, sorted(values, reverse=True)[:8], atol=1e-11 * max(1, values[0]))
        assert np.allclose(vectors_.T @ vectors_, np.eye(8), atol=1e-10) and np.allclose(a @ vectors_, vectors_ * got, atol=1e-10 * max(1, values[0]))
        assert passes <= 6


def test_whitening_of_little(spark):
    shape = "vec_id long, embedding array<float>"
    make = lambda rows: [tuple(r) for r in whiten(spark.createDataFrame(rows, shape)).collect()]
    assert make([]) == [] and make([(1, [1.0, 2.0])]) == [] and make([(1, [1.0, 2.0])] * 4) == [] and make([(1, None)]) == []
    got = make([(1, [0.0, 2.0]), (2, [1.0, 2.0])])  # one direction has variance
    assert [(r[0], r[1], r[2], r[3], r[5]) for r in got] == [(1, 1, 2, 1024**2, 1.0), (2, 1, 2, 1024**2, 1.0)] and {round(abs(r[4]), 9) for r in got} == {1.0}


def test_deviations_beyond_longs(spark):
    big = float(2**38)
    got = whiten(spark.createDataFrame([(1, [big]), (2, [-big]), (3, [0.0])], "vec_id long, embedding array<double>")).orderBy("vec_id").collect()
    assert [r.deviation for r in got] == [None, None, 0] and got[2].whitened == 0 and abs(got[0].explained - 1) < 1e-12


@pytest.mark.parametrize("chunk", [256, 0, 4])
def test_rare_shingles_lose_no_link(spark, chunk):
    """Groups of near and of half alike sets, cut into cells never (256: small ones), where that is cheaper, or nearly always (0): the links that brute force finds."""
    rng = random.Random(12)
    sets, groups = [], []
    for g in range(6):
        core = [rng.getrandbits(60) for _ in range(30)]
        for _ in range(14):
            own = rng.choice([0, 2, 3, 4, 30])
            sets.append(sorted({*rng.sample(core, 30 - rng.choice([0, 1, 2])), *[rng.getrandbits(60) for _ in range(own)]}))
            groups.append(g)
    rows = [(i, i, g, groups.count(g), groups.count(g) - 1, i % 14 != 0, s) for i, (g, s) in enumerate(zip(groups, sets))]
    members = spark.createDataFrame(rows, "id long, root long, grp long, size long, rest long, minor boolean, s array<long>")
    before, neardup.CHUNK = neardup.CHUNK, chunk
    try:
        cut = neardup.by_rare_shingles(members, 0.8, len(rows)).cache()
    finally:
        neardup.CHUNK = before
    if chunk == 256:
        assert cut.count() == len(rows)
    found = {(min(r.a, r.b), max(r.a, r.b)) for r in neardup.links_within(cut, 0.8).collect()}
    near = [(i, j) for j in range(len(rows)) for i in range(j) if groups[i] == groups[j] and len(set(sets[i]) & set(sets[j])) >= 0.8 * len(set(sets[i]) | set(sets[j]))]
    assert found <= set(near)
    top = lambda pairs: union(len(rows), pairs)
    assert top(sorted(found)) == top(near) and len(near) > 50


def test_texts_of_one_template_are_not_compared(spark, monkeypatch):
    """200 texts of which half is the same: no cell is left to compare."""
    monkeypatch.setattr(neardup, "CHUNK", 64)
    rng = random.Random(13)
    core = [rng.getrandbits(60) for _ in range(50)]
    rows = [(i, i, 1, 200, 199, i > 0, sorted({*core, *[rng.getrandbits(60) for _ in range(50)]})) for i in range(200)]
    members = spark.createDataFrame(rows, "id long, root long, grp long, size long, rest long, minor boolean, s array<long>")
    assert neardup.by_rare_shingles(members, 0.8, 200).count() == 0
