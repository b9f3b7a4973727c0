"""Operators that compare rows: SimHash, suffixes, anchors, components."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import xxhash

from driftwell.llm import anchors, common, neardup, simhash, sketches, suffixes
from driftwell.llm.common import components
from driftwell.llm.words import Words, spread, window_hashes

from .conftest import prose


def same(got, expected):
    assert sorted(map(repr, got)) == sorted(map(repr, expected))


def union(n, pairs):
    up = list(range(n))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in pairs:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return [top(i) for i in range(n)]


def fingerprint(text, words, seed=42):
    w = (text or "").encode().lower().split()
    s = [b" ".join(w[i : i + words]) for i in range(max(1, len(w) - words + 1))] if w else []
    h = [xxhash.xxh64_intdigest(x, seed) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def expected_components(rows, most=2):
    prints = [fingerprint(r[1], 3) for r in rows]
    roots = union(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= most])
    least = {}
    for r, root in zip(rows, roots):
        if r[0] is not None:
            least[root] = min(least.get(root, r[0]), r[0])
    return [(r[0], f"{p:016x}", least.get(root)) for r, p, root in zip(rows, prints, roots)]


@pytest.mark.parametrize("chunk", [2048, 2])
def test_near_duplicates_match_brute_force(docs, rows, monkeypatch, chunk):
    monkeypatch.setattr(simhash, "CHUNK", chunk)
    got = simhash.near_duplicates(docs).collect()
    same([(r.doc_id, f"{r.f0 % (1 << 64):016x}", r.component_id) for r in got], expected_components(rows))


def test_grid_links_lose_nothing(spark):
    rng = random.Random(4)
    values = {rng.getrandbits(64) for _ in range(40)} | {0, (1 << 64) - 1, 1 << 63}
    for v in list(values):
        values |= {v ^ sum(1 << b for b in rng.sample(range(64), rng.choice([1, 2, 3]))) for _ in range(12)}
    values = sorted(values)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    nodes = spark.createDataFrame(list(enumerate(signed)), "id long, f0 long")
    found = [(r.a, r.b) for r in simhash.links(nodes, 2).collect()]
    assert all((values[a] ^ values[b]).bit_count() <= 2 for a, b in found)
    near = [(i, j) for i in range(len(values)) for j in range(i) if (values[i] ^ values[j]).bit_count() <= 2]
    assert union(len(values), found) == union(len(values), near)


def test_two_bits_apart_meet():
    rng = np.random.default_rng(6)
    a = rng.integers(0, 1 << 63, size=400, dtype=np.uint64) << np.uint64(1)
    b = a ^ (np.uint64(1) << rng.integers(0, 64, size=400).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, size=400).astype(np.uint64))
    assert (simhash.first_meeting(a, b) < np.iinfo(np.int64).max).all()


def test_grid_in_numpy_is_the_grid_in_sql(spark):
    rng = np.random.default_rng(5)
    words = rng.integers(0, 1 << 63, size=50, dtype=np.uint64) << np.uint64(1)
    words[0], words[1] = 0, (1 << 64) - 1
    frame = spark.createDataFrame([(int(x),) for x in words.view(np.int64)], "f0 long")
    sql = [sorted(r[0]) for r in frame.select(simhash.visited(frame.f0, simhash.packed_counts(frame.f0))).collect()]
    assert sql == [sorted(x for x in r.tolist() if x != -1) for r in simhash.visited_cells(words)]
    near = words ^ (np.uint64(1) << rng.integers(0, 64, size=50).astype(np.uint64))
    own = [set(r) for r in sql]
    other = [set(r[r != -1].tolist()) for r in simhash.visited_cells(near)]
    assert simhash.first_meeting(words, near).tolist() == [min(a & b) for a, b in zip(own, other)]


def test_forest_connects_like_all_pairs():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, size=3, dtype=np.uint64)
    rows = np.concatenate([b ^ (np.uint64(1) << rng.integers(0, 8, size=20, dtype=np.uint64)) for b in base])
    near = [(i, j) for i in range(60) for j in range(i) if int(rows[i] ^ rows[j]).bit_count() <= 1]
    assert union(60, simhash.forest(rows, 1)) == union(60, near)


def test_deduplicate_is_exact_on_its_candidates(spark):
    """Texts with more and more words changed: who stays is what all pairs of similarity 0.8 leave."""
    rng = random.Random(21)
    texts = []
    for _ in range(6):
        base = prose(rng, 150).split()
        for share in (0, 0.005, 0.01, 0.02, 0.03, 0.05, 0.2):
            texts.append(" ".join(w if rng.random() >= share else "new" + w for w in base))
    rng.shuffle(texts)
    sets = [frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) for w in map(str.split, texts)]
    alike = lambda a, b: len(sets[a] & sets[b]) / len(sets[a] | sets[b])
    n = len(texts)
    roots = union(n, [(a, b) for a in range(n) for b in range(a) if alike(a, b) >= 0.8])
    left = {r.doc_id for r in neardup.deduplicate(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert set(roots) <= left  # no text goes that is not similar to one that stays
    assert all(alike(a, b) < 0.88 for a in left for b in left if a < b)  # the fingerprints may miss a pair near the limit


def test_isolated_pairs_at_the_limit_are_found(spark):
    """Pairs of similarity 0.80 to 0.82 that nothing else links: nearly all lose one text."""
    rng = random.Random(31)
    texts, pairs = [], 0
    while pairs < 200:
        base = [f"w{rng.getrandbits(40):x}" for _ in range(124)]
        other = list(base)
        for i in (10, 60):
            other[i] = "new" + other[i]
        for i in range(rng.choice([1, 2, 3])):
            other[-1 - i] = "new" + other[-1 - i]
        a, b = ({tuple(w[i : i + 5]) for i in range(120)} for w in (base, other))
        assert 0.79 <= len(a & b) / len(a | b) <= 0.85
        pairs += len(a & b) / len(a | b) >= 0.8
        texts += [" ".join(base), " ".join(other)] if len(a & b) / len(a | b) >= 0.8 else []
    left = neardup.deduplicate(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).count()
    assert left <= 200 + 10


@pytest.mark.parametrize("chunk", [256, 30])
def test_variants_of_one_text_are_all_linked(spark, monkeypatch, chunk):
    """Many variants around the limit, with and without the text they come from: who stays is what all pairs leave."""
    monkeypatch.setattr(neardup, "CHUNK", chunk)
    rng = random.Random(11)
    texts = []
    for k in range(2):
        base = prose(rng, 150).split()
        texts += [" ".join(w if rng.random() >= 0.022 else f"new{rng.random()}" for w in base) for _ in range(110)]
        texts += [" ".join(base)] * k
    sets = [frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) for w in map(str.split, texts)]
    near = [(a, b) for a in range(len(texts)) for b in range(a) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    left = {r.doc_id for r in neardup.deduplicate(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert left == set(union(len(texts), near))


@pytest.mark.parametrize("n", [5, 9, 14, 20, 31, 40, 63, 64, 100, 127, 130, 200, 255, 260, 310, 500, 1000, 5000])
def test_similar_sets_meet(n):
    """Pairs of sets of a similarity of 0.8 or a little more, of all sizes, nearly always have a cell in common."""
    rng = np.random.default_rng(n)
    met, pairs = 0, 300
    for _ in range(pairs):
        both = rng.integers(0, 1 << 63, size=n, dtype=np.uint64)
        differ = rng.permutation(n)[: n // 5]
        cut = rng.integers(0, len(differ) + 1)
        a, b = np.delete(both, differ[:cut]), np.delete(both, differ[cut:])
        x, y = neardup.cells_of([np.sort(a), np.sort(b)], 0.8)
        met += len(np.intersect1d(x, y)) > 0
    assert met >= pairs - 4
    alone = neardup.cells_of([np.sort(rng.integers(0, 1 << 63, size=n, dtype=np.uint64)) for _ in range(20)], 0.8)
    assert len(np.unique(np.concatenate(alone))) == sum(map(len, alone)) and max(map(len, alone)) <= 2 * neardup.GROUPS


def test_the_grid_links_copies_that_meet_nowhere_else(spark, monkeypatch):
    """Without the cells of shingle samples those stay linked whose fingerprints differ in two bits or fewer."""
    monkeypatch.setattr(neardup, "cells_of", lambda sets, share: [np.zeros(0, dtype=np.uint64) for _ in sets])
    rng = random.Random(41)
    texts = []
    for _ in range(40):
        base = [f"w{rng.getrandbits(40):x}" for _ in range(300)]
        texts += [" ".join(base), " ".join([*base, "new"]), " ".join(["other", *base[1:]])]
    sets = [neardup.shingle_set(t.encode(), 5) for t in texts]
    prints = [int(x) for x in simhash.majority(np.concatenate(sets), np.array([len(x) for x in sets]))]
    near = [(a, b) for a in range(len(texts)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 2 and len(np.intersect1d(sets[a], sets[b])) >= 0.8 * len(np.union1d(sets[a], sets[b]))]
    left = {r.doc_id for r in neardup.deduplicate(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert left == set(union(len(texts), near)) and len(left) < 80


def test_common_counts(monkeypatch):
    monkeypatch.setattr(neardup, "COLUMNS", 7)
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 60, size=rng.integers(1, 40))) for _ in range(15)]
    rows = np.array([0, 3, 14])
    assert neardup.common_counts(sets, rows).tolist() == [[len(np.intersect1d(sets[i], x)) for x in sets] for i in rows]


def test_deduplicate_keeps_one_of_each_group(spark):
    rng = random.Random(9)
    texts = [prose(rng, 200) for _ in range(12)]
    rows = [(100 + i, t) for i, t in enumerate(texts)] + [(i, t) for i, t in enumerate(texts[:4])]
    for i, t in enumerate(texts[4:8]):
        w = t.split(" ")
        w[50] = "other"
        rows.append((200 + i, " ".join(w)))
    rows += [(300, None), (301, ""), (302, " "), (None, texts[0]), (102, texts[2])]
    out = neardup.deduplicate(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    same([r.doc_id for r in out], [0, 1, 2, 3, *range(104, 112), 300, 301, 302])
    assert neardup.deduplicate(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_one_group_of_a_third_of_all_rows(spark):
    rng = random.Random(2)
    copy = prose(rng, 80)
    rows = [(i, copy if i % 3 == 0 else prose(rng, 40)) for i in range(300)]
    got = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sum(r.component_id == 0 for r in got) == 100


def test_components(spark, empty):
    rng = random.Random(6)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(30)] + [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(90)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    roots = union(300, edges)
    touched = {x for e in edges for x in e if e[0] != e[1]}
    assert got == {x: roots[x] for x in touched}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_bytes(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[k : k + length] for b in raw for k in range(len(b) - length + 1))
    out = []
    for b in raw:
        drop = bytearray(len(b) + 1)
        for k in range(len(b) - length + 1):
            if seen[b[k : k + length]] > 1:
                drop[k : k + length] = b"\1" * length
        kept = bytes(x for x, d in zip(b, drop) if not d)
        out.append((len(b), sum(drop), sum(drop[i] and not (i and drop[i - 1]) for i in range(len(b))), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize(("length", "gram", "hot", "bucket"), [(400, 32, 1500, 1 << 20), (60, 12, 1500, 4000), (60, 12, 1, 4000), (16, 4, 3, 4000)])
def test_suffix_dedup_matches_brute_force(docs, rows, length, gram, hot, bucket):
    got = suffixes.suffix_dedup(docs, length=length, gram=gram, group_pieces=hot, bucket_bytes=bucket).collect()
    same([(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got], [(r[0], *x) for r, x in zip(rows, brute_bytes([r[1] for r in rows], length))])


def test_run_length_index():
    rng = random.Random(1)
    strings = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(1, 60))) for _ in range(12)]
    strings += [strings[0], b"a" * 40, b"abcabcabcabcabcabc"]
    index = suffixes.RunLengthIndex(strings)
    match = index.matching_statistics()
    suffix = [(i, s[k:]) for i, s in enumerate(strings) for k in range(len(s))]
    for i, s in enumerate(strings):
        for k in range(len(s)):
            best = 0
            for j, (o, t) in enumerate(suffix):
                if not (o == i and len(t) == len(s) - k):
                    n = 0
                    while n < min(len(t), len(s) - k) and t[n] == s[k + n]:
                        n += 1
                    best = max(best, n)
            assert match[index.starts[i] + k] == best
    assert index.run_lengths.sum() == index.n and (index.run_symbols[1:] != index.run_symbols[:-1]).all()


def brute_words(rows, window):
    first = {}
    split = [(None if r[0] is None else r[0], (r[1] or "").encode().split()) for r in rows]
    big = 1 << 70
    for i, w in split:
        for k in range(len(w) - window + 1):
            g = tuple(w[k : k + window])
            first[g] = min(first.get(g, big), big - 1 if i is None else i)
    out = []
    for i, w in split:
        drop = [False] * len(w)
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < (big - 1 if i is None else i):
                drop[k : k + window] = [True] * window
        out.append((i, len(w), sum(drop), hashlib.sha256(b" ".join(x for x, d in zip(w, drop) if not d)).hexdigest()))
    return out


@pytest.mark.parametrize(("window", "period", "cover"), [(50, 31, anchors.COVER), (12, 7, (1, 2, 4)), (5, 3, (0, 1))])
def test_substring_dedup_matches_brute_force(docs, rows, window, period, cover):
    got = anchors.substring_dedup(docs, window=window, period=period, cover=cover).collect()
    same([(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got], brute_words(rows, window))
    assert sum(r.n_removed for r in got)


def test_every_match_shares_an_anchor():
    assert anchors.covers(anchors.COVER, anchors.PERIOD) and not anchors.covers((0, 1, 2), 31)
    for i in range(31):
        for j in range(31):
            assert any((i + d) % 31 in anchors.COVER and (j + d) % 31 in anchors.COVER for d in range(31))


def test_scratch_tables_go(spark):
    mark = common.scratch_mark()
    tables = [common.written(spark.range(n), "t") for n in (1, 2, 3)]
    common.drop_scratch(spark, mark, keep=1)
    assert common.scratch_mark() == mark + 1 and tables[2].count() == 3
    common.drop_written(spark, tables[2])
    with pytest.raises(Exception):
        tables[2].count()


def test_sets_of_rows_as_bitmaps(spark):
    rng = random.Random(5)
    rows = [(part << 33) + i for part in range(4) for i in range(40_000 if part == 1 else 50)] + [32768, 32769]
    some = rng.sample(rows, 700) + [0, 1, 32768]
    frame = spark.createDataFrame([(r, "x") for r in rows], "row long, other string")
    bits = common.row_bits(spark.createDataFrame([(r,) for r in some], "row long"), "row")
    assert sorted(r.row for r in common.in_bits(frame, "row", bits).collect()) == sorted(r for r in rows if r in set(some))
    assert common.in_bits(frame, "row", common.row_bits(frame.limit(0), "row")).count() == 0


def test_empty_tables(empty):
    assert simhash.near_duplicates(empty).count() == 0
    assert neardup.deduplicate(empty).count() == 0
    assert suffixes.suffix_dedup(empty).count() == 0
    assert anchors.substring_dedup(empty).count() == 0


def test_word_arrays(rows):
    texts = [(r[1] or "").encode() for r in rows]
    w = Words(texts)
    flat = [x for t in texts for x in t.split()]
    assert w.first[-1] == len(flat) == len(w.a)
    assert len(set(w.a.tolist())) == len(set(flat)) == len(set(w.b.tolist()))
    for width in (1, 2, 3, 7, 50):
        windows = window_hashes(w.a, width)
        assert len(windows) == len(flat) - width + 1
        assert len(set(windows.tolist())) == len({tuple(flat[i : i + width]) for i in range(len(flat) - width + 1)})
    assert len(window_hashes(w.a[:3], 4)) == 0
    assert [x.tolist() for x in spread(np.array([2, 0, 3]))] == [[0, 0, 2, 2, 2], [0, 1, 0, 1, 2]]


def thue_morse(n, zero, one):
    return "".join(one if i.bit_count() % 2 else zero for i in range(n))


def test_structured_words_are_told_apart(spark):
    """Sequences of 1,024 symbols on which polynomials modulo 2 ** 64 collide for every odd base."""
    a, b = thue_morse(1024, "a", "b"), thue_morse(1024, "b", "a")
    words = [f"w{i}" for i in range(49)]
    texts = [" ".join([*words[:20], a, *words[20:]]), " ".join([*words[:20], b, *words[20:]])]
    rows = [(i, t) for i, t in enumerate(texts)]
    got = anchors.substring_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    same([(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got], brute_words(rows, 50))
    assert all(r.n_removed == 0 for r in got)


def test_structured_bytes_are_told_apart(spark):
    rng = random.Random(3)
    head = ["".join(rng.choice("cdefgh") for _ in range(60)) for _ in range(4)]
    texts = [head[0] + thue_morse(1024, "a", "b") + head[1], head[2] + thue_morse(1024, "b", "a") + head[3]]
    rows = [(i, t) for i, t in enumerate(texts)]
    got = suffixes.suffix_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    same([(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got], [(r[0], *x) for r, x in zip(rows, brute_bytes(texts, 400))])


def test_ids_of_other_kinds(spark, docs, rows):
    """Text ids order as text; the greatest long is not taken for null."""
    named = [(None if r[0] is None else f"d{r[0]:03d}", r[1]) for r in rows]
    expected = {(None if i is None else f"d{i:03d}", *x) for i, *x in brute_words(rows, 50)}
    got = anchors.substring_dedup(spark.createDataFrame(named, "doc_id string, text string"), texts=False).collect()
    assert {(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got} == expected
    text = " ".join(f"w{i}" for i in range(60))
    got = anchors.substring_dedup(spark.createDataFrame([((1 << 63) - 1, text), (None, text + " more")], "doc_id long, text string")).collect()
    assert {r.doc_id: r.n_removed for r in got} == {(1 << 63) - 1: 0, None: 60}


@pytest.mark.parametrize("pieces", [2, 1500])
def test_passages_in_many_texts(spark, pieces):
    """Passages below and above the length in texts that differ around them: cut finer and finer, nothing is lost."""
    rng = random.Random(14)
    make = lambda n: "".join(rng.choice("abcdefghij ") for _ in range(n))
    passages = [make(n) for n in (250, 390, 399, 400, 401, 700)]
    texts = [make(rng.randrange(50, 500)) + rng.choice(passages) + make(rng.randrange(50, 500)) for _ in range(60)]
    texts += ["ab" * 600, "ab" * 450, "x" * 900]
    got = suffixes.suffix_dedup(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), group_pieces=pieces, bucket_bytes=20_000).collect()
    same([(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got], [(i, *x) for i, x in enumerate(brute_bytes(texts, 400))])


def test_long_texts_are_cut_in_parts(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "CHUNK_BYTES", 700)
    rng = random.Random(15)
    make = lambda n: "".join(rng.choice("abcdefghij ") for _ in range(n))
    shared = make(900)
    texts = [make(3000) + shared + make(2500), make(10) + shared + make(5000), make(1099)]
    got = suffixes.suffix_dedup(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    same([(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got], [(i, *x) for i, x in enumerate(brute_bytes(texts, 400))])


@pytest.mark.parametrize("given, held", [("10m", str(common.SENT_BYTES)), ("1g", str(common.SENT_BYTES)), ("256k", "256k"), ("-1", "-1"), (None, str(common.SENT_BYTES))])
def test_little_is_sent_while_copies_are_found(spark, given, held):
    """The driver builds no large tables for the joins of these operators; the session's limit is as before afterwards, also when one fails."""
    key, docs = common.SENT_KEYS[0], spark.range(1)
    failing = common.sends_little(lambda docs: 1 / 0)
    spark.conf.unset(key) if given is None else spark.conf.set(key, given)
    try:
        assert common.sends_little(lambda docs: docs.sparkSession.conf.get(key))(docs) == held
        with pytest.raises(ZeroDivisionError):
            failing(docs)
        assert spark.conf.get(key, None) == given
    finally:
        spark.conf.unset(key)
    for operator in (neardup.deduplicate, simhash.near_duplicates, sketches.minhash_near_duplicates):
        assert operator.__wrapped__.__name__ == operator.__name__
