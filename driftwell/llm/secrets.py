"""Operator 2, secret scans: corpus-wide ownership frequency.

Candidates are found by pattern in each text, hashed, and counted over the whole corpus by distinct
repositories and owners. A value that many owners hold is a copied example; one that a single owner
holds in few repositories and that looks random is a live credential of that owner.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import apart, written

#: Kinds in the order in which spans of equal start are listed. Fixed patterns: kind, pattern, group with the value, least length of the value.
BASE = (
    ("assign", re.compile(r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 24),
)
#: Opaque tokens, which the corpus counts must confirm: 20 or more characters with a digit and both cases.
OPAQUE, DIGIT = re.compile(r"[A-Za-z0-9+/_-]{20,}"), re.compile("[0-9]")
KINDS = ("assign", "access", "hex", "opaque")
#: A value of so many owners, or in so many repositories, is a copied example.
COPIED_OWNERS, COPIED_REPOSITORIES = 3, 10
LIVE_BITS = 2.5
OPAQUE_BITS = 3.5
PLACEHOLDER = re.compile(r"example|sample|changeme|placeholder|your[_-]|dummy|xxxx|1234567|(.)\1{5}", re.IGNORECASE)

#: A search is skipped when none of these occurs in the text.
HINT = re.compile(r"[pP][aA][sS][sS]|[sS][eE][cC][rR]|[tT][oO][kK][eE]|[aA][pP][iI]")


def entropy(value: str) -> float:
    """Shannon entropy of the characters, in bits a character."""
    return -sum(c / len(value) * math.log2(c / len(value)) for c in Counter(value).values())


def base_spans(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, value) of the fixed patterns: leftmost, non-overlapping per kind."""
    found = []
    for kind, pattern, group, least in BASE:
        if kind == "assign" and not HINT.search(text) or kind == "access" and "AKIA" not in text:
            continue
        found += [(kind, m.start(), m.end(), m[group]) for m in pattern.finditer(text) if len(m[group]) >= least]
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


def opaque_spans(text: str, taken: list[tuple[str, int, int, str]]) -> list[tuple[str, int, int, str]]:
    """High-entropy tokens that overlap no base span; taken: those, by start."""
    starts, reach = [s for _, s, _, _ in taken], list(accumulate((e for _, _, e, _ in taken), max))
    found = []
    for m in OPAQUE.finditer(text):
        before = bisect_left(starts, m.end())  # spans that start before its end
        if before and reach[before - 1] > m.start() or not DIGIT.search(v := m[0]):
            continue
        if v.lower() != v != v.upper() and entropy(v) >= OPAQUE_BITS:
            found.append(("opaque", m.start(), m.end(), v))
    return found


def joined(spans: list[tuple]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e, *_ in spans)


def scan(docs: DataFrame, text: str, owner: str, repository: str, keep: tuple[str, ...]) -> DataFrame:
    """One row a text, with its base counts and candidates (kind, start, end, hash, live)."""
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    source = docs.select(*[docs[c].alias(f"__k{i}") for i, c in enumerate(keep)], docs[owner].cast("string").alias("owner"), docs[repository].cast("string").alias("repository"), docs[text].alias("text"))
    shape = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("hash", pa.string()), ("live", pa.bool_())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests, spans, candidates = [], [], [], []
            for t in batch.column(batch.num_columns - 1):
                t = t.as_py() or ""
                base = base_spans(t)
                counts.append([sum(k == kind for k, *_ in base) for kind in KINDS[:3]])
                spans.append(joined(base))
                digests.append(hashlib.sha256(spans[-1].encode()).hexdigest())
                candidates.append([{"kind": k, "start": s, "end": e, "hash": hashlib.sha256(v.encode()).hexdigest(), "live": not PLACEHOLDER.search(v) and entropy(v) >= LIVE_BITS} for k, s, e, v in [*base, *opaque_spans(t, base)]])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *[pa.array([c[i] for c in counts], pa.int64()) for i in range(3)], pa.array(digests, pa.string()), pa.array(spans, pa.string()), pa.array(candidates, shape)],
                names=[*batch.schema.names[:-1], "n_assign", "n_access", "n_hex", "base_sha256", "base_spans", "candidates"],
            )

    shown = "".join(f"__k{i} {kinds[c]}, " for i, c in enumerate(keep))
    return source.mapInArrow(run, shown + "owner string, repository string, n_assign long, n_access long, n_hex long, base_sha256 string, base_spans string, candidates array<struct<kind:string,start:bigint,end:bigint,hash:string,live:boolean>>").withColumn("__row", F.monotonically_increasing_id())


def ownership(candidates: DataFrame) -> DataFrame:
    """(hash, n_repositories, n_owners) of candidates(hash, owner, repository); null owners count as one owner.

    Each step aggregates before it shuffles, so a hash that is everywhere is no hot spot.
    """
    by_repository = candidates.groupBy("hash", "owner", "repository").agg(F.lit(1).alias("one"))
    by_owner = by_repository.groupBy("hash", "owner").agg(F.count("*").alias("n"))
    return by_owner.groupBy("hash").agg(F.sum("n").alias("n_repositories"), F.count("*").alias("n_owners"))


def secret_scan(docs: DataFrame, text: str = "text", owner: str = "source", repository: str = "doc_id", keep: tuple[str, ...] = ("doc_id",), copied_owners: int = COPIED_OWNERS, copied_repositories: int = COPIED_REPOSITORIES) -> DataFrame:
    """Spans and ownership of the secrets of each text.

    Columns: `keep`, n_assign, n_access, n_hex, base_sha256, spans (kind:start:end, code points), n_live
    (candidates of one owner that look random), n_copied (held by `copied_owners` owners or by
    `copied_repositories` repositories or more),
    findings (array of kind, start, end, hash, n_repositories, n_owners, verdict).
    Base spans are always in `spans`; an opaque token is added only if it is live.

    Null or empty text: no spans. Null owner: one owner of that name. Repeated rows: each gets its own row.
    Texts are searched whole, in time that grows with their length, unbroken runs of letters included. An empty table gives an empty table; other columns are ignored, as are those
    of `keep` that are named like a new one. A value that very many texts hold is counted by aggregates;
    its counts come back by a join of written tables, which Spark splits where a value is hot.
    """
    keep = apart(keep, "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_live", "n_copied", "findings")
    found = written(scan(docs, text, owner, repository, keep), "secrets", rows=docs.count(), each=5_000)
    each = found.select("__row", "owner", "repository", F.explode("candidates").alias("c")).select("__row", "owner", "repository", "c.*")
    counts = written(ownership(each), "secret-counts", rows=found.agg(F.coalesce(F.sum(F.size("candidates")), F.lit(0)).alias("n")).first()["n"])
    verdict = F.when((F.col("n_owners") >= copied_owners) | (F.col("n_repositories") >= copied_repositories), "copied").when((F.col("n_owners") == 1) & F.col("live"), "live").otherwise("shared")
    judged = each.join(counts, "hash").withColumn("verdict", verdict).where("kind <> 'opaque' or verdict = 'live'")
    order = F.expr("array_position(array('assign', 'access', 'hex', 'opaque'), kind)").cast("int")
    rows = judged.groupBy("__row").agg(
        F.sort_array(F.collect_list(F.struct("start", order.alias("rank"), "end", "kind", "hash", "n_repositories", "n_owners", "verdict"))).alias("findings"),
        F.sum((F.col("verdict") == "live").cast("long")).alias("n_live"),
        F.sum((F.col("verdict") == "copied").cast("long")).alias("n_copied"),
    )
    spans = F.expr("concat_ws(',', transform(findings, x -> concat(x.kind, ':', x.start, ':', x.end)))")
    out = found.join(rows, "__row", "left")
    zero = F.lit(0).cast("long")
    return out.select(
        *[F.col(f"__k{i}").alias(c) for i, c in enumerate(keep)], "n_assign", "n_access", "n_hex", "base_sha256",
        F.coalesce(spans, F.lit("")).alias("spans"), F.coalesce("n_live", zero).alias("n_live"), F.coalesce("n_copied", zero).alias("n_copied"),
        F.expr("transform(findings, x -> named_struct('kind', x.kind, 'start', x.start, 'end', x.end, 'hash', x.hash, 'n_repositories', x.n_repositories, 'n_owners', x.n_owners, 'verdict', x.verdict))").alias("findings"),
    )
