"""Operators whose rows are independent: quality, tokens, language, containment."""

import base64
import random
import re
from collections import Counter

import pytest

from driftwell.llm.contain import BLOCK_WORDS, containment
from driftwell.llm.language import SCRIPT_NAMES, Letters, fit, held_out, identify_languages, viterbi
from driftwell.llm.quality import BANDS, band, quality_rules
from driftwell.llm.tokens import token_counts

from .conftest import prose


def same(got, expected):
    assert sorted(map(repr, got)) == sorted(map(repr, expected))


def base_measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(3)}
    seen, lines = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            lines += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), lines, len(inside), len(words) < 50 or 100 * len(inside) > 50 * len(words)


def test_quality_base_columns(docs, rows):
    got = quality_rules(docs, keep=("doc_id",)).collect()
    same([(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got], [(r[0], *base_measures(r[1])) for r in rows])
    assert all(not r.kept for r in got if r.base_failed)


def test_quality_bands(spark):
    rng = random.Random(1)
    clean = prose(rng, 700)
    noise = " ".join(base64.b85encode(rng.randbytes(30)).decode() for _ in range(200))
    table = " ".join(f"k{i % 7}={i}" for i in range(900))
    got = {r.doc_id: r for r in quality_rules(spark.createDataFrame([(1, clean), (2, noise), (3, table)], "doc_id long, text string"), keep=("doc_id",)).collect()}
    assert got[1].kept
    assert not got[2].kept and got[2].verdict == "incompressible"
    assert not got[3].kept and got[3].verdict == "repetitive"


def test_quality_band_limits():
    assert band(128) == BANDS[0][1:] and band(129) == BANDS[1][1:] and band(10**9) == BANDS[-1][1:]


def test_quality_all_columns_and_empty(docs, empty):
    out = quality_rules(docs)
    assert out.columns[:2] == ["doc_id", "text"] and out.columns.count("kept") == 1
    assert quality_rules(empty).count() == 0


def test_tokens_match_the_library(docs, rows, empty):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as f:
        spec = f.read()
    got = token_counts(docs, spec).collect()
    counts = [len(library.encode(r[1] or "", add_special_tokens=False).ids) for r in rows]
    same([tuple(r) for r in got], [(r[0], len((r[1] or "").encode()), n, n > 1024) for r, n in zip(rows, counts)])
    assert token_counts(empty, spec).count() == 0


def language_texts(n, seed):
    """Words of a made-up language each: different vowels; greek by script."""
    rng = random.Random(seed)
    make = {"aa": lambda: "".join(rng.choice("bcdf") + rng.choice("ae") for _ in range(3)), "oo": lambda: "".join(rng.choice("bcdf") + rng.choice("ou") for _ in range(3)), "gr": lambda: "".join(rng.choice("αβγδεη") for _ in range(5))}
    return {k: [" ".join(f() for _ in range(30)) for _ in range(n)] for k, f in make.items()}


def test_language_held_out_accuracy_and_spans(spark):
    made = language_texts(60, 3)
    rows = [(i * 3 + j, t, k) for j, (k, texts) in enumerate(made.items()) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("held_out", held_out())
    model = fit(frame.where("not held_out"), "text", "lang")
    assert model["names"] == ["aa", "gr", "oo"]
    out = identify_languages(frame, model, keep=("doc_id", "held_out", "lang")).where("held_out").collect()
    assert len(out) > 20 and all(r.lang == r.lang_pred for r in out)
    mixed = made["aa"][0] + " " + made["gr"][0] + " " + made["oo"][0] + " " + made["oo"][1]
    odd = spark.createDataFrame([(1, mixed), (2, None), (3, ""), (4, "12 34!"), (5, "βαβα")], "doc_id long, text string")
    got = {r.doc_id: r for r in identify_languages(odd, model).collect()}
    assert [x.split(":")[0] for x in got[1].spans.split(",")] == ["aa", "gr", "oo"] and got[1].lang_pred == "oo"
    assert [got[i].lang_pred for i in (2, 3, 4, 5)] == ["und", "und", "und", "gr"]
    assert got[2].score == 0 and all(0 <= r.score <= 1 for r in got.values())


def test_language_edge_cases(docs, rows, empty):
    model = fit(docs, "text", "lang")
    assert identify_languages(docs, model).count() == len(rows)
    assert fit(empty, "text", "lang") is None
    assert {r.lang_pred for r in identify_languages(docs, None).collect()} == {"und"}
    assert identify_languages(empty, model).count() == 0


def test_viterbi_is_the_best_path():
    import itertools

    import numpy as np

    rng = np.random.default_rng(2)
    first = np.array([0, 0, 5, 6, 12])
    scores = rng.normal(size=(12, 3)).astype(np.float32)
    labels = viterbi(scores, first, 0.7)
    value = lambda path, s: sum(s[i, x] for i, x in enumerate(path)) - 0.7 * sum(a != b for a, b in zip(path, path[1:]))
    for lo, hi in zip(first, first[1:]):
        if lo < hi:
            best = max(value(p, scores[lo:hi]) for p in itertools.product(range(3), repeat=hi - lo))
            assert value(labels[lo:hi], scores[lo:hi]) == pytest.approx(best)


def test_scripts():
    t = Letters()
    assert [SCRIPT_NAMES[t.script[ord(c)]] for c in "aéßαжא日あ한"] == ["latin", "latin", "latin", "greek", "cyrillic", "hebrew", "han", "kana", "hangul"]


def test_held_out_is_crc32_mod_5(spark):
    import zlib

    got = spark.range(50).withColumnRenamed("id", "doc_id").select("doc_id", held_out().alias("x")).collect()
    assert all(r.x == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)


def contained(docs, items):
    words = lambda t: re.findall(r"[a-z0-9\u0080-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    shingles = lambda w, n: {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}
    asked = [(k, shingles(w, min(5, len(w))), min(5, len(w))) for k, x in items if (w := words(x))]
    out = []
    for i, t in docs:
        own = {n: shingles(words(t), n) for n in range(1, 6)}
        out.append((i, sorted(k for k, x, n in asked if len(x & own[n]) >= 0.8 * len(x))))
    return out


@pytest.mark.parametrize("block_words", [BLOCK_WORDS, 40])
def test_containment_matches_brute_force(spark, docs, rows, block_words):
    rng = random.Random(8)
    texts = [r[1] for r in rows if r[1] and len(r[1].split()) > 30]
    items = [(i, " ".join(t.split()[5:25])) for i, t in enumerate(texts[:12])]
    cut = [" ".join([*x.split()[:n], *prose(rng, 20 - n).split()]) for (_, x), n in zip(items, (19, 18, 17, 16, 15, 12))]
    items += [(100 + i, x) for i, x in enumerate(cut)] + [(200, None), (201, ""), (202, "one"), (203, "two WORDS!"), (204, items[0][1]), (205, items[0][1].upper())]
    out = containment(docs, spark.createDataFrame(items, "item_id long, text string"), block_words=block_words).collect()
    same([(r.doc_id, [m["item"] for m in r.matches]) for r in out], contained([r[:2] for r in rows], items))
    assert any(len(r.matches) for r in out)


def test_containment_empty(spark, docs, rows, empty):
    none = spark.createDataFrame([], "item_id long, text string")
    assert all(not r.matches for r in containment(docs, none).collect())
    assert containment(empty, none).count() == 0


def test_viterbi_of_long_texts_and_many_labels():
    import numpy as np

    n = 400_000
    scores = np.full((n, 2), -30.0, dtype=np.float32)
    scores[: n // 2, 1] -= 0.5
    scores[n // 2 :, 0] -= 0.5
    labels = viterbi(scores, np.array([0, n]), 8.0)
    assert (labels[: n // 2] == 0).all() and (labels[n // 2 :] == 1).all()
    scores = np.zeros((6, 200), dtype=np.float32)
    scores[:3, 150] = scores[3:, 199] = 90
    assert viterbi(scores, np.array([0, 6]), 8.0).tolist() == [150] * 3 + [199] * 3


def test_rare_languages_are_learned(spark):
    """A language with a thousandth of the rows, and a text that a third of all rows repeat."""
    made = language_texts(40, 9)
    rows = [(i, rng_text, "aa") for i, rng_text in enumerate(made["aa"] * 30)]
    rows += [(10_000 + i, made["oo"][0], "oo") for i in range(600)]
    rows += [(20_000, made["gr"][0], "gr"), (20_001, made["gr"][1], "gr")]
    model = fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), "text", "lang", rows=90)
    assert model["names"] == ["aa", "gr", "oo"]
