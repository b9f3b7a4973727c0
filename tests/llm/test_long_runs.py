"""Texts that hold very long unbroken or periodic runs."""

import random
import time
import tracemalloc

import pytest

from driftwell.llm import secrets, suffixes, tokens
from driftwell.llm.contain import containment
from driftwell.llm.suffixes import class_widths, pieces_of, suffix_dedup

from .test_links import brute_bytes, same


def slow_opaque(text, taken):
    """The candidates one by one, each against every base span."""
    found, run = [], ""
    allowed = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-")
    for i, c in enumerate(text + "\0"):
        if c in allowed:
            run += c
            continue
        start, v, run = i - len(run), run, ""
        if len(v) >= 20 and any(x.isdigit() for x in v) and v.lower() != v != v.upper() and secrets.entropy(v) >= secrets.OPAQUE_BITS and not any(s < i and start < e for _, s, e, _ in taken):
            found.append(("opaque", start, i, v))
    return found


def test_opaque_tokens_are_the_same():
    rng = random.Random(1)
    for _ in range(60):
        parts = [rng.choice(["a" * 30, "Ab3" + "xYz9Qw" * 4, "0123456789abcdef" * 2, "token=Ab3" + "kLm7Pq" * 5, "AKIA" + "X7" * 12 + "y", "Zz" * 15, " "]) for _ in range(30)]
        text = rng.choice(["", " "]).join(parts)
        base = secrets.base_spans(text)
        assert secrets.opaque_spans(text, base) == slow_opaque(text, base)


@pytest.mark.parametrize("text", ["xY" * 5_000_000, "xY" * 4_999_999 + "9", "\n".join(f"{i:024x} Tok{i:05}QwErTyUiOpAsDf" for i in range(60_000))])
def test_secrets_of_ten_megabytes(text):
    began = time.time()
    base = secrets.base_spans(text)
    found = secrets.opaque_spans(text, base)
    assert time.time() - began < 20 and len(found) in (0, 60_000) and len(base) in (0, 60_000)


@pytest.fixture(scope="module")
def merger():
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    with open(path, encoding="utf-8") as f:
        return tokens.Merger(f.read()), Tokenizer.from_file(path)


def test_long_sequences_are_merged_alike(merger, monkeypatch):
    own, library = merger
    rng = random.Random(2)
    texts = ["a" * n for n in (1, 2, 3, 7, 4097, 9000)] + ["ab" * 5000, "=" * 8191, " " * 5000, "é" * 3000, "日本" * 2500, "aaab" * 2000 + "a"]
    texts += ["".join(rng.choice("etaoinshr") for _ in range(n)) for n in (5, 60, 700, 5000, 20000)] + ["".join(chr(rng.randrange(97, 123)) for _ in range(6000))]
    want = [len(library.encode(t, add_special_tokens=False).ids) for t in texts]
    assert own.count(texts) == want
    assert [own.merge_long(t.encode()) for t in texts if t.isalpha()] == [n for t, n in zip(texts, want) if t.isalpha()]
    monkeypatch.setattr(tokens, "LONG", 3)
    own.known.clear()
    assert own.count(texts) == want


def test_a_megabyte_of_letters(merger):
    own, library = merger
    rng = random.Random(3)
    text = "".join(rng.choice("etaoinshrdlu") for _ in range(1_000_000))
    began = time.time()
    assert own.count([text]) == [len(library.encode(text, add_special_tokens=False).ids)]
    assert time.time() - began < 60


def test_nine_megabytes_of_one_byte():
    tracemalloc.start()
    pieces = [(found, bodies) for found, bodies in pieces_of([b"-" * 9_000_000], 400, 32, class_widths(400, 32)[0], suffixes.FOLD)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(len(b) for _, b in pieces) < 100 and peak < 600_000_000
    assert sum((f[5] * f[6]).sum() for f, _ in pieces) == 9_000_000 - 399


@pytest.mark.parametrize("chunk", [suffixes.CHUNK_BYTES, 700])
def test_periodic_runs_match_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(suffixes, "CHUNK_BYTES", chunk)
    rng = random.Random(4)
    noise = lambda n: "".join(chr(rng.randrange(97, 123)) for _ in range(n))
    texts = ["-" * n for n in (399, 400, 401, 3000)] + [noise(n) * k for n, k in ((2, 700), (3, 300), (10, 90), (63, 20), (64, 20), (65, 20), (150, 8))]
    texts += [f"{noise(300)}{'=' * 900}{noise(300)}", f"{noise(200)}{'=' * 500}{noise(300)}{'=' * 450}", "ab" * 220 + "x" + "ab" * 230, noise(1500), "+" * 400, noise(399) + "+", ""]
    rows = list(enumerate(texts))
    got = suffix_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(2), texts=False).collect()
    same([tuple(r) for r in got], [(i, *x) for (i, _), x in zip(rows, brute_bytes(texts, 400))])


def test_short_items_in_long_texts(spark):
    docs = spark.createDataFrame([(1, "who knows what seven plus five may be " * 9), (2, "Seven, plus: five"), (3, "seven plus"), (4, "five plus seven"), (5, None)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "seven plus five"), (2, "SEVEN"), (3, "who knows what seven plus"), (4, "plus four")], "item_id long, text string")
    got = {r.doc_id: [(m.item, m.containment) for m in r.matches] for r in containment(docs, items).collect()}
    assert got == {1: [(1, 1.0), (2, 1.0), (3, 1.0)], 2: [(1, 1.0), (2, 1.0)], 3: [(2, 1.0)], 4: [(2, 1.0)], 5: []}
