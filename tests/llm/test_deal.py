"""Sharding, mixing and the pipeline."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from driftwell.llm.mixing import exponent, mix_sources
from driftwell.llm.sharding import communication_matrix, even, hypergeometric, shard_rows


def test_hypergeometric_follows_its_law():
    rng = random.Random(3)
    draws = [hypergeometric(40, 60, 25, rng) for _ in range(20_000)]
    p = [math.comb(40, k) * math.comb(60, 25 - k) / math.comb(100, 25) for k in range(26)]
    counts = Counter(draws)
    chi = sum((counts[k] - 20_000 * q) ** 2 / (20_000 * q) for k, q in enumerate(p) if 20_000 * q > 5)
    assert chi < 45 and min(draws) >= 0 and max(draws) <= 25
    assert hypergeometric(0, 9, 4, rng) == 0 and hypergeometric(9, 0, 4, rng) == 4 and hypergeometric(5, 5, 0, rng) == 0
    big = [hypergeometric(10**10, 3 * 10**10, 10**9, rng) for _ in range(5)]
    assert all(abs(x - 25 * 10**7) < 10**5 for x in big)


def test_matrix_has_its_margins():
    rows, columns = [5, 0, 17, 8], [10, 10, 10]
    m = communication_matrix(rows, columns, 1)
    assert [sum(r) for r in m] == rows and [sum(c) for c in zip(*m)] == columns and min(min(r) for r in m) >= 0
    with pytest.raises(ValueError):
        communication_matrix([1], [2], 0)
    assert even(7, 3) == [3, 2, 2]


def test_sharding_is_exact_and_repeatable(docs, rows):
    dealt = shard_rows(docs, shards=7, partitions=5, cells=3)
    got = dealt.select("doc_id", "text", "shard", "slot").collect()
    assert len(got) == len(rows) and Counter(map(repr, ((r.doc_id, r.text) for r in got))) == Counter(repr((r[0], r[1])) for r in rows)
    by = defaultdict(list)
    for r in got:
        by[r.shard].append(r.slot)
    assert sorted(by) == list(range(7)) and all(sorted(s) == list(range(len(s))) for s in by.values())
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1
    again = shard_rows(docs.repartition(6), shards=7, partitions=5, cells=3).select("doc_id", "text", "shard", "slot").collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))
    assert dealt.columns.count("shard") == 1


def test_sharding_is_uniform(spark):
    ids = spark.range(400).withColumnRenamed("id", "doc_id")
    counts = np.zeros((400, 4))
    for seed in range(25):
        for r in shard_rows(ids, shards=4, seed=seed, key=("doc_id",), partitions=8, cells=2).collect():
            counts[r.doc_id, r.shard] += 1
    assert abs(counts.sum(0) - 2500).max() == 0
    expected = 25 / 4
    assert 0.8 < ((counts - expected) ** 2 / expected).sum() / (400 * 3) < 1.2


def test_sharding_small(spark, empty):
    assert shard_rows(empty).count() == 0
    assert [(r.shard, r.slot) for r in shard_rows(spark.range(1), key=("id",)).collect()] == [(0, 0)]


def test_native_plans(docs):
    for df in (shard_rows(docs), mix_sources(docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "ExistingRDD"))


def entropy(w):
    return -sum(x * math.log(x) for x in w)


def weights(tokens, a):
    w = [t**a for t in tokens]
    return [x / sum(w) for x in w]


@pytest.mark.parametrize(("share", "most"), [(0.9, 100.0), (0.999, 100.0), (0.999, 1.5), (0.1, 4.0), (1.0, 1000.0)])
def test_exponent(spark, share, most):
    tokens = [1000, 300, 200, 50, 10]
    a = exponent(spark.createDataFrame([(t,) for t in tokens], "tokens long"), share, most)
    meets = lambda a: entropy(weights(tokens, a)) >= share * math.log(5) - 1e-9
    repeats = lambda a: (1000 / 10) ** (1 - a)
    grid = [i / 10_000 for i in range(10_001)]
    best = max([x for x in grid if meets(x)], default=0)
    if repeats(best) > most:
        best = min(x for x in grid if repeats(x) <= most)
    assert a == pytest.approx(best, abs=2e-4)
    assert exponent(spark.createDataFrame([(5,)], "tokens long"), share, most) == 1


def mixture(spark):
    rng = random.Random(3)
    rows = [(i, "w " * rng.randrange(1, 30), "big" if i % 10 < 7 else "mid" if i % 10 < 9 else "small") for i in range(600)]
    return rows + [(1000, None, "small"), (1001, "", "silent"), (1002, None, "silent"), (1003, "a b c", None), (1004, "a b c", ""), (1004, "a b c", "")]


def test_mixing_takes_every_document_once_at_least(spark):
    rows = mixture(spark)
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mix_sources(frame, entropy_share=0.7, most_repeats=3.5, blocks=16).collect()
    assert {r.doc_id for r in out} == {r[0] for r in rows}
    total, got, repeats, docs, largest = Counter(), Counter(), {}, defaultdict(Counter), Counter()
    for i, t, s in rows:
        total[s] += len((t or "").split())
        largest[s] = max(largest[s], len((t or "").split()))
    for r in out:
        got[r.source] += r.n_tokens
        repeats[r.source] = r.repeats
        docs[r.source][(r.doc_id, r.epoch)] += 1
    for s in total:
        if total[s]:
            assert 0 <= total[s] * repeats[s] - got[s] < largest[s] + 1
            assert 1 <= repeats[s] <= 3.5 + 1e-6
    assert repeats["big"] == pytest.approx(1) and repeats[None] == pytest.approx(3.5, abs=0.4)
    assert all(n == 1 for s, c in docs.items() for k, n in c.items() if s != "")
    assert {(r.doc_id, r.epoch) for r in out if r.source == "silent"} == {(1001, 0), (1002, 0)}


def test_mixing_with_a_budget(spark):
    rows = mixture(spark)
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mix_sources(frame, budget=3000, blocks=8).collect()
    got = Counter()
    for r in out:
        got[r.source] += r.n_tokens
    weight = {r.source: r.weight for r in out if r.weight is not None}
    assert sum(weight.values()) == pytest.approx(1, abs=0.01)
    assert all(-30 < got[s] - 3000 * w <= 1 for s, w in weight.items())
    big = {(r.epoch, r.block_position) for r in out if r.source == "big"}
    assert big == {(0, i) for i in range(len(big))} and 1 < len(big) < 8  # whole blocks in their order, then part of one


def test_mixing_edge_cases(docs, rows, empty):
    assert mix_sources(empty).count() == 0
    out = mix_sources(docs.withColumn("epoch", F.lit("x")))
    assert out.columns.count("epoch") == 1 and out.count() >= len(rows)


def test_pipeline_against_brute_force(spark, docs, rows, tmp_path):
    """Every stage on its own input: who is kept is what plain Python keeps; how often, what the sources' weights allow."""
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    from .test_links import union
    from .test_op_queries import verdicts
    from .test_rows import base_measures, contained

    docs.write.parquet(str(tmp_path / "documents.parquet"))
    items = [(1, " ".join(next(r[1] for r in rows if r[0] == 44).split()[10:40])), (2, "never found in any of these texts at all")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    at = docs
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        at = stage(spark, at, str(tmp_path))
        seen[name] = [tuple(r) for r in at.collect()]
    quality, near, clean, mixed, dealt = seen.values()
    same = lambda got, want: sorted(map(repr, got)) == sorted(map(repr, want))
    assert same(quality, [r for r in rows if not base_measures(r[1])[-1] and verdicts(r[1])[1] == "in band"])
    shingles = [frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) for r in quality for w in [r[1].lower().split()]]
    n = len(quality)
    roots = union(n, [(a, b) for a in range(n) for b in range(a) if len(shingles[a] & shingles[b]) >= 0.8 * len(shingles[a] | shingles[b])])
    first = {}
    for r, root in zip(quality, roots):
        first[root] = min(first.get(root, r), r, key=lambda r: (r[0] is None, r[0]))
    assert len(first) < n and same(near, first.values())
    found = {i for i, m in contained([r[:2] for r in near], items) if m}
    assert found and same(clean, [r for r in near if r[0] not in found])
    tokens, copies = Counter(), Counter(map(repr, mixed))
    for r in clean:
        tokens[r[3]] += len(r[1].split())
    best = max([a for a in (i / 5000 for i in range(5001)) if entropy(weights(tokens.values(), a)) >= 0.9 * math.log(len(tokens)) - 1e-9], default=0.0)
    if (max(tokens.values()) / min(tokens.values())) ** (1 - best) > 4:
        best = min(a for a in (i / 5000 for i in range(5001)) if (max(tokens.values()) / min(tokens.values())) ** (1 - a) <= 4)
    for r in clean:
        wanted = (max(tokens.values()) / tokens[r[3]]) ** (1 - best)  # epochs of the source
        assert math.floor(wanted - 0.01) <= copies[repr(r)] <= math.ceil(wanted + 0.01)
    assert set(copies) == set(map(repr, clean))
    out = docs.columns.index("shard")  # a column of that name gives way
    assert same([r[:-2] for r in dealt], [r[:out] + r[out + 1 :] for r in mixed])
    assert [c for c in at.columns if c not in ("shard", "slot")] == [c for c in docs.columns if c != "shard"]
    shards = defaultdict(list)
    for r in dealt:
        shards[r[-2]].append(r[-1])
    assert all(sorted(x) == list(range(len(x))) for x in shards.values()) and max(map(len, shards.values())) - len(dealt) // 40 <= 1
    assert len(corpus_pipeline.run(spark, str(tmp_path)).collect()) == len(dealt)


def test_pipeline_of_nothing(spark, empty, tmp_path):
    """No documents, no items: no rows, all columns. The session's size of batches is as before."""
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    empty.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.collect() == [] and set(empty.columns) <= {*out.columns} and out.columns[-2:] == ["shard", "slot"]
    assert spark.conf.get(key) == before
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).collect() == []
    spark.conf.set(key, before)


def test_pipeline_sends_texts_in_small_batches(spark, docs):
    """The stages with Python workers cut Spark's default number of rows in a batch; a number that was set stays."""
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    key, default = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"
    before = spark.conf.get(key)
    try:
        for value, after in ((default, "1000"), ("77", "77")):
            spark.conf.set(key, value)
            corpus_pipeline.quality(spark, docs, "")
            assert spark.conf.get(key) == after
    finally:
        spark.conf.set(key, before)
