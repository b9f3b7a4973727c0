import hashlib
import re

from driftwell.llm.secrets import secret_scan

PATTERNS = (("assign", r"""(?a:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6), ("access", "AKIA[A-Z0-9]+", 0, 20), ("hex", "[0-9a-f]+", 0, 24))


def brute(text):
    spans = [(m.start(), i, m.end(), kind) for i, (kind, p, g, least) in enumerate(PATTERNS) for m in re.finditer(p, text or "") if len(m[g]) >= least]
    joined = ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(spans))
    return *[sum(x[3] == k for x in spans) for k in ("assign", "access", "hex")], hashlib.sha256(joined.encode()).hexdigest(), joined


def test_base_spans_match_brute_force(docs, rows):
    got = secret_scan(docs).collect()
    expected = [(r[0], *brute(r[1])) for r in rows]
    assert sorted(repr((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256)) for r in got) == sorted(repr(x[:5]) for x in expected)
    assert sum(r.n_assign for r in got) >= 3
    for r in got:
        assert {x for x in r.spans.split(",") if not x.startswith("opaque")} in [set(x[5].split(",")) for x in expected if x[0] == r.doc_id and x[4] == r.base_sha256] or r.spans == ""


def test_ownership_separates_copied_examples_from_live_values(spark):
    copied, live, opaque = "password=Tr0ub4dor3xK", "password=q8ZmK2vX9LrT", "Xy7Kp2Qw9Rt4Lm8Nv3Bz6Hc1"
    rows = [(i, f"doc {i} {copied}", f"owner{i % 4}") for i in range(8)] + [(10, live, "me"), (11, live, "me"), (12, opaque, "me"), (13, "password=example", "you"), (14, None, None)]
    rows += [(20 + i, "Ab3" * 9, f"owner{i}") for i in range(4)]
    got = {r.doc_id: r for r in secret_scan(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert all(got[i].n_copied == 1 and got[i].n_live == 0 for i in range(8))
    assert got[10].n_live == 1 and got[10].findings[0]["n_repositories"] == 2 and got[10].findings[0]["n_owners"] == 1
    assert got[12].spans == "opaque:0:24" and got[12].n_assign == 0
    assert got[13].n_live == 0 and got[13].n_assign == 1
    assert all(got[i].spans == "" for i in (14, 20, 21, 22, 23))


def test_empty(empty):
    assert secret_scan(empty).count() == 0
