"""The queries as they are registered, column by column, against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
import zstandard

from driftwell.llm import queries as q
from driftwell.llm.quality import BANDS

from .conftest import prose
from .test_new_ranks import check_whitening, jaccard_components, ranked, vectors
from .test_links import brute_bytes, brute_words, expected_components
from .test_rows import base_measures, contained
from .test_secrets import brute


@pytest.fixture(scope="module")
def sf(spark, rows, tmp_path_factory):
    """A folder with documents (and a column that is named like a result), benchmark and embeddings."""
    top = tmp_path_factory.mktemp("sf")
    spark.createDataFrame([r[:5] for r in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(str(top / "documents.parquet"))
    items = [(1, " ".join(next(r[1] for r in rows if r[0] == 44).split()[10:40])), (2, "never found in any of these texts at all"), (3, None)]
    spark.createDataFrame(vectors(), "vec_id long, embedding array<float>, label int, n string, x string").repartition(3).write.parquet(str(top / "embeddings.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(top / "benchmark.parquet"))
    return str(top), items


def result(spark, sf, name):
    df = q.queries()[name](spark, sf[0])
    return [tuple(r) for r in df.collect()], df.columns


def same(got, expected):
    assert sorted(map(repr, got)) == sorted(map(repr, expected))


def out_of_band(raw):
    ratio = len(raw) / len(zstandard.ZstdCompressor(level=3).compress(raw))
    lo, hi = next((lo, hi) for most, lo, hi in BANDS if most is None or len(raw) <= most)
    return ratio, "incompressible" if ratio < lo else "repetitive" if ratio > hi else "in band"


def verdicts(text):
    raw = (text or "").encode()
    if not raw:
        return None, "empty"
    ratio, verdict = out_of_band(raw)
    chunks = [out_of_band(raw[i : i + 4096])[1] != "in band" for i in range(0, len(raw), 4096)]
    return ratio, "chunks out of band" if verdict == "in band" and 2 * sum(chunks) > len(chunks) else verdict


def test_op1(spark, sf, rows):
    got, names = result(spark, sf, "op1_quality_rules")
    want = []
    for r in rows:
        n, chars, symbols, lines, repeats, failed = base_measures(r[1])
        ratio, verdict = verdicts(r[1])
        want.append({"doc_id": r[0], "n_words": n, "word_chars": chars, "n_symbols": symbols, "n_dup_lines": lines, "n_repeat_words": repeats, "base_failed": failed, "ratio": ratio, "verdict": verdict, "kept": not failed and verdict == "in band"})
    shown = [dict(zip(names, r)) for r in got]
    same([{k: r[k] for k in want[0]} for r in shown], want)


def test_the_bands_decide(spark):
    """Texts that the base keeps and the bands reject, and prose that both keep."""
    from driftwell.llm.quality import quality_rules

    rng = random.Random(4)
    menu = "\n".join(f"{prose(rng, 1)} | {prose(rng, 1)} |" for _ in range(160)).replace("a", "aaaa")
    marked = " ".join(f"{prose(rng, 1)}{rng.choice(['$$$', '***', '&&&'])}" for _ in range(900))
    texts = [prose(rng, 90), prose(rng, 800), prose(rng, 9000), marked, menu]
    got = {r.doc_id: r for r in quality_rules(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert not any(r.base_failed for r in got.values())
    assert [got[i].kept for i in range(5)] == [True, True, True, False, False]


def entropy(v):
    return -sum(c / len(v) * math.log2(c / len(v)) for c in Counter(v).values())


def test_op2(spark, sf, rows):
    got, names = result(spark, sf, "op2_secret_scan")
    patterns = {"assign": 2, "access": 0, "hex": 0}
    found, holders = [], defaultdict(set)
    for r in rows:
        t = r[1] or ""
        base = [(int(s), k, int(e)) for k, s, e in (x.split(":") for x in brute(t)[4].split(",") if x)]
        opaque = []
        for m in re.finditer(r"(?=[A-Za-z+/_-]*[0-9])[A-Za-z0-9+/_-]{20,}", t):
            v = m[0]
            if re.search("[a-z]", v) and re.search("[A-Z]", v) and entropy(v) >= 3.5 and not any(s < m.end() and m.start() < e for s, _, e in base):
                opaque.append((m.start(), "opaque", m.end()))
                holders[v].add((r[3], r[0]))
        found.append((r[0], base, opaque, t))
    want = []
    for i, base, opaque, t in found:
        live = []
        for s, k, e in opaque:
            v = t[s:e]
            owners = {o for o, _ in holders[v]}
            placeholder = re.search(r"example|sample|changeme|placeholder|your[_-]|dummy|xxxx|1234567|(.)\1{5}", v, re.I)
            if len(owners) == 1 and len(holders[v]) < 10 and not placeholder:
                live.append((s, k, e))
        order = ["assign", "access", "hex", "opaque"]
        spans = ",".join(f"{k}:{s}:{e}" for s, k, e in sorted([*base, *live], key=lambda x: (x[0], order.index(x[1]))))
        want.append((i, *[sum(k == x for _, k, _ in base) for x in patterns], brute(t)[3], spans))
    at = [names.index(c) for c in ("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")]
    same([tuple(r[i] for i in at) for r in got], want)
    assert any(w[5] for w in want)


def test_op3(spark, sf, rows):
    got, names = result(spark, sf, "op3_language_id")
    assert names[:4] == ["doc_id", "held_out", "lang_pred", "score"] and len(got) == len(rows)
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 0
    learned = {r[2] for r in rows if r[2] is not None and r[1] is not None and not held(r[0])}
    texts = defaultdict(set)
    for r in rows:
        texts[r[0]].add(any(c.isalpha() for c in r[1] or ""))
    for i, out, lang, score, *_ in got:
        assert out == held(i) and 0 <= score <= 1
        assert lang in learned if texts[i] == {True} else lang == "und" if texts[i] == {False} else True


def test_op3_on_held_out_texts(spark):
    """Nineteen of twenty labels of texts that the model has not seen are right."""
    import os

    data = "/root/testdata/sf0.001"
    if not os.path.isdir(data):
        pytest.skip("no test data")
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{data}/documents.parquet").where("lang IS NOT NULL AND text IS NOT NULL").collect()}
    got = [r for r in q.op3_language_id(spark, data).collect() if r.held_out and r.doc_id in truth and r.lang_pred != "und"]
    right = sum(r.lang_pred == truth[r.doc_id] for r in got)
    assert len(got) >= 20 and right >= 0.95 * len(got)


def test_op4(spark, sf, rows):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    count = [len(library.encode(r[1] or "", add_special_tokens=False).ids) for r in rows]
    got, _ = result(spark, sf, "op4_token_counts")
    same(got, [(r[0], len((r[1] or "").encode()), n, n > 1024) for r, n in zip(rows, count)])


def test_op5(spark, sf, rows):
    got, names = result(spark, sf, "op5_sharding")
    assert names == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    same([r[:3] for r in got], [(r[0], len((r[1] or "").encode()) + 16, zlib.crc32((r[1] or "").encode())) for r in rows])
    slots = defaultdict(list)
    for r in got:
        assert r[3] == "rows" and r[6] is None
        slots[r[4]].append(r[5])
    assert set(slots) == set(range(40)) and all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def test_op6(spark, sf, rows):
    got, names = result(spark, sf, "op6_suffix_array_dedup")
    assert names == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    same(got, [(r[0], *x) for r, x in zip(rows, brute_bytes([r[1] for r in rows], 400))])


def test_op7(spark, sf, rows):
    got, names = result(spark, sf, "op7_benchmark_decontamination")
    assert names == ["doc_id", "item_id", "contained_permille"]
    same([r[:2] for r in got], [(i, k) for i, found in contained([r[:2] for r in rows], sf[1]) for k in found])
    assert got and all(800 <= r[2] <= 1000 for r in got)


def test_op8(spark, sf, rows):
    got, names = result(spark, sf, "op8_simhash_near_dedup")
    assert names == ["doc_id", "fingerprint", "component_id"]
    same(got, expected_components(rows))


def test_op9(spark, sf, rows):
    """Weights of the exponent that brute force finds; every document in the epochs that its source's tokens allow."""
    got, names = result(spark, sf, "op9_temperature_mixing")
    tokens = Counter()
    for r in rows:
        tokens[r[3]] += len((r[1] or "").split()) if not re.search(r"[\x1c-\x1f\x85\xa0]", r[1] or "") else len(re.findall(r"[^\x20\x09-\x0D]+", r[1]))
    known = {s: t for s, t in tokens.items() if t}
    weights = lambda a: {s: t**a / sum(x**a for x in known.values()) for s, t in known.items()}
    spread = lambda w: -sum(x * math.log(x) for x in w.values())
    best = max([a for a in (i / 5000 for i in range(5001)) if spread(weights(a)) >= 0.9 * math.log(len(known)) - 1e-9], default=0.0)
    if max((max(known.values()) / t) ** (1 - best) for t in known.values()) > 4:
        best = min(a for a in (i / 5000 for i in range(5001)) if max((max(known.values()) / t) ** (1 - a) for t in known.values()) <= 4)
    at = {c: names.index(c) for c in names}
    for r in got:
        if r[at["source"]] in known:
            assert r[at["weight"]] == pytest.approx(weights(best)[r[at["source"]]], abs=2e-3)
    assert Counter(r[at["doc_id"]] for r in got).keys() == {r[0] for r in rows}
    # every document is in the first epochs of its source, one after the other, and in one more at most
    epochs, sources = defaultdict(list), {r[0]: r[3] for r in rows}
    for r in got:
        epochs[r[at["doc_id"]]].append(r[at["epoch"]])
    times = Counter(r[0] for r in rows)
    for i, own in epochs.items():
        if times[i] == 1 and sources[i] in known:
            repeats = next(r[at["repeats"]] for r in got if r[at["doc_id"]] == i)
            assert sorted(own) == list(range(len(own))) and math.floor(repeats + 1e-9) <= len(own) <= math.floor(repeats + 1e-9) + 1
    # a block of a source has one place in an epoch, and places follow each other
    places = defaultdict(dict)
    for r in got:
        places[r[at["source"]], r[at["epoch"]]].setdefault(r[at["block_position"]], set()).add(r[at["doc_id"]])
    for (source, epoch), blocks in places.items():
        if (source, 0) in places and source in known:
            assert all(any(b <= first for first in places[source, 0].values()) for b in blocks.values())
    sums, largest = Counter(), Counter()
    for r in got:
        sums[r[at["source"]]] += r[at["n_tokens"]]
        largest[r[at["source"]]] = max(largest[r[at["source"]]], r[at["n_tokens"]])
    for s, t in known.items():
        repeats = next(r[at["repeats"]] for r in got if r[at["source"]] == s)
        assert -1 < t * repeats - sums[s] < 2 * largest[s] + 1  # equal rows count as one document


def test_op10(spark, sf, rows):
    got, names = result(spark, sf, "op10_difference_cover_dedup")
    assert names == ["doc_id", "n_words", "n_removed", "n_spans", "kept_sha256"]
    same([r[:3] + r[4:] for r in got], brute_words([r[:2] for r in rows], 50))


def test_op11(spark, sf, rows):
    got, names = result(spark, sf, "op11_minhash_near_dedup")
    assert names == ["doc_id", "n_shingles", "component_id", "kept"]
    same(got, jaccard_components([r[:2] for r in rows], 85))


def test_op12(spark, sf, rows):
    got, names = result(spark, sf, "op12_lexical_search")
    assert names == ["item_id", "rank", "doc_id", "score"]
    same(got, ranked([r[:2] for r in rows], sf[1], 20))


def test_op13(spark, sf):
    got, names = result(spark, sf, "op13_embedding_whitening")
    assert names == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check_whitening(got, vectors())


def test_all_are_there():
    assert {f"op{n}" for n in range(1, 14)} == {n.split("_")[0] for n in q.queries()}


def test_near_dedup_finds_pairs_at_ninety(spark):
    """Isolated pairs of similarity 0.9 or more: one text of each goes."""
    from driftwell.llm.neardup import deduplicate

    rng = random.Random(77)
    texts = []
    for _ in range(150):
        base = [f"w{rng.getrandbits(40):x}" for _ in range(150)]
        other = list(base)
        other[rng.randrange(150)] = "new"
        a, b = ({tuple(w[i : i + 5]) for i in range(146)} for w in (base, other))
        assert len(a & b) / len(a | b) >= 0.9
        texts += [" ".join(base), " ".join(other)]
    left = {r.doc_id for r in deduplicate(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert sum(not {2 * i, 2 * i + 1} <= left for i in range(150)) >= 149


def test_clashing_names(spark, rows):
    """Columns called like helping or new ones."""
    from driftwell.llm.mixing import mix_sources
    from driftwell.llm.secrets import secret_scan
    from driftwell.llm.sharding import shard_rows
    from driftwell.llm.neardup import deduplicate

    names = ["whole", "before", "rest", "turns", "cut", "n", "__h", "__block", "_h", "f0", "__row", "column0", "shard", "epoch", "spans", "places", "__place"]
    few = [r[:2] + (r[3],) + ("x",) * len(names) for r in rows[:40]]
    docs = spark.createDataFrame(few, "doc_id long, text string, source string, " + ", ".join(f"`{n}` string" for n in names))
    own = lambda df, *new: [c for c in df.columns if c not in new]
    mixed, dealt, left = mix_sources(docs), shard_rows(docs, shards=3), deduplicate(docs)
    assert own(mixed, "n_tokens", "weight", "repeats", "epoch", "block_position", "order_key") == own(docs, "epoch") and mixed.count() >= 40
    assert own(dealt, "shard", "slot") == own(docs, "shard") and dealt.count() == 40
    assert left.columns == docs.columns and 0 < left.count() <= 40
    found = secret_scan(docs, keep=("doc_id", "spans", "whole"))
    assert found.columns[:2] == ["doc_id", "whole"] and found.count() == 40 and hashlib.sha256(b"").hexdigest() in {r.base_sha256 for r in found.collect()}
