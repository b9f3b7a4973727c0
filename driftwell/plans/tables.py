"""Tables: an append-only Parquet log, and a descriptor that says how to read it.

The log is a set of runs, one a batch. In a clustered table every run is dealt out by a hash of the key
into the same number of buckets, each sorted by the key, as Spark's bucketed tables are. The rows of a key
then lie in the same bucket of all runs, so its latest row is found without a shuffle. Runs are merged in
tiers: of TIER runs of a tier one of the next is made, and only these runs are read and written for it.

A table may have a folder for each value of its partition columns instead, which readers skip by filters.

A column has a logical name and the name that files hold it by. Renaming changes the first only;
changing the type begins a new file column and reads older files by a cast; a column that is dropped
and added again is a new one. So no file is ever rewritten by a schema change.
"""

from __future__ import annotations

import hashlib
import json
import re
import time
import uuid
from collections import Counter
from dataclasses import asdict, dataclass, field, replace
from datetime import datetime, timezone

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.align import align, missing_columns, unfit
from ..operators.envelope import PART
from ..operators.state import DELETED, SEQ, SIGN, VERSION, collapse, latest, latest_by_column, needed_by_column
from ..operators.versions import GTID_BITS
from .ddl import Action, DdlError, target_type, unquoted
from .ddl import Column as SourceColumn
from .store import Files

REPLACING, COLLAPSING, APPEND = "replacing", "collapsing", "append"
#: Types whose values name folders as they are.
FOLDER_KINDS = ("smallint", "int", "bigint", "string", "date", "boolean")
NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")
TRUNCATE = "_truncate"
#: The descriptor's serial when a row was written: it lacks columns that were added later.
SCHEMA = "_schema"
LOST = "__lost"
#: Column of a clustered table's runs; runs of a tier that are merged into one of the next.
RUN, TIER = "__run", 8
#: Rows of a part of a batch that one task writes, about.
TASK_ROWS = 1_000_000
#: Where a row came from (topic/partition; offsets of different places have no order) and when, by the source's clock in ms.
PLACE, TIME = "_place", "_ts"
#: The whole transaction number of a row whose version holds its low bits only.
NUMBER = "_txn"


@dataclass(frozen=True)
class Field:
    name: str
    kind: str
    nullable: bool = True
    stored: str = ""
    older: tuple[tuple[str, str], ...] = ()  # (stored name, type) of earlier types
    default: str | None = None
    computed: str | None = None
    since: int = 0  # serial of the descriptor that first had it
    filled: str | None = None  # what rows from before that show


@dataclass(frozen=True)
class Descriptor:
    database: str
    name: str
    fields: tuple[Field, ...]
    key: tuple[str, ...] = ()
    partition: tuple[str, ...] = ()
    engine: str = REPLACING
    deleted: str = DELETED
    constraints: dict[str, str] = field(default_factory=dict)
    serial: int = 0
    data: str = "data-0"
    applied: int = -1  # place in the log of the last schema change
    replicated: bool = False  # of the target's engine; means nothing to files
    buckets: int = 0  # of a clustered table
    partial: bool = False  # images may leave unchanged texts out
    folders: bool = False  # one for each value of the partition columns

    def to_json(self) -> str:
        return json.dumps(asdict(self), indent=1)

    @classmethod
    def from_json(cls, text: str) -> Descriptor:
        d = json.loads(text)
        d["fields"] = tuple(Field(**f | {"older": tuple(map(tuple, f["older"]))}) for f in d["fields"])
        return cls(**d | {"key": tuple(d["key"]), "partition": tuple(d["partition"])})

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]

    def schema(self) -> T.StructType:
        """Logical columns, computed ones included."""
        return T.StructType([T.StructField(f.name, T._parse_datatype_string(f.kind), f.nullable) for f in self.fields])

    def extras(self) -> list[tuple[str, str]]:
        mark = [(SIGN, "int")] if self.engine == COLLAPSING else [(self.deleted, "int")]
        return [(VERSION, "bigint"), (SEQ, "bigint"), *mark, (TRUNCATE, "boolean"), (PLACE, "string"), (TIME, "bigint"), (NUMBER, "bigint"), (SCHEMA, "int")]

    def stored_schema(self) -> T.StructType:
        """Columns that files may hold, earlier types included."""
        own = [x for f in self.fields if f.computed is None for x in ((f.stored, f.kind), *f.older)]
        return T.StructType([T.StructField(n, T._parse_datatype_string(k), True) for n, k in [*own, *self.extras()]])

    def index(self, name: str) -> int:
        at = [i for i, f in enumerate(self.fields) if f.name == unquoted(name)]
        if not at:
            raise KeyError(f"{self.database}.{self.name} has no column {name}")
        return at[0]

    def with_field(self, f: Field, place: str | None = None) -> Descriptor:
        """f added, under a stored name of its own."""
        new, rest = replace(f, stored=f"{f.name}__{self.serial}" if self.serial else f.name, since=self.serial + 1), list(self.fields)
        rest.insert(0 if place == "first" else self.index(place) + 1 if place else len(rest), new)
        return replace(self, fields=tuple(rest), serial=self.serial + 1)


def field_of(c: SourceColumn, nullable: bool, zone: str = "") -> Field:
    return Field(unquoted(c.name), target_type(c, zone)[1].simpleString(), nullable, default=c.default, computed=c.generated)


def default_text(text: str | None, ts_ms: int | None) -> str | None:
    """The value of a DEFAULT clause as text that a cast reads: literals, and the time of the change for the current one; None for null and other expressions."""
    plain = (text or "NULL").strip()
    while plain.startswith("(") and plain.endswith(")"):
        plain = plain[1:-1].strip()
    if re.fullmatch(r"(?i)(current_timestamp|now|localtime|localtimestamp)\s*(\(\s*\d*\s*\))?", plain):
        at = datetime.fromtimestamp((time.time_ns() // 1_000_000 if ts_ms is None else ts_ms) / 1000, timezone.utc)
        return at.strftime("%Y-%m-%d %H:%M:%S.%fZ")
    if m := re.fullmatch(r"(?is)(?P<mark>b|x|n|date|time|timestamp|_\w+)?\s*(?P<quote>['\"])(?P<body>.*)(?P=quote)", plain):
        mark, body = (m["mark"] or "").lower(), m["body"].replace(m["quote"] * 2, m["quote"])
        body = re.sub(r"\\(.)", lambda e: {"n": "\n", "t": "\t", "r": "\r", "0": "\0"}.get(e[1], e[1]), body)
        return str(int(body or "0", 2)) if mark == "b" else str(int(body or "0", 16)) if mark == "x" else body
    if re.fullmatch(r"[+-]?(\d+\.?\d*|\.\d+)(?i:e[+-]?\d+)?", plain) or plain.lower() in ("true", "false"):
        return plain
    return None


def filling(f: Field, ts_ms: int | None) -> str | None:
    """What rows from before the column show: its default, or, where it can't be null, nothing's value of its type."""
    found = default_text(f.default, ts_ms)
    if found is None and not f.nullable and f.computed is None:
        kind = f.kind.partition("(")[0]
        found = "" if kind == "string" else "false" if kind == "boolean" else "1970-01-01" if kind in ("date", "timestamp", "timestamp_ntz") else "0" if kind in NUMBERS else None
    return found


def literal_of(text: str | None, kind: str) -> Column:
    """A default's text as a value; numbers are truth values of a boolean."""
    if kind == "boolean" and text is not None and re.fullmatch(r"[+-]?\d+", text):
        return F.lit(int(text) != 0)
    return F.lit(text).try_cast(kind)


def mark_name(names: list[str], wanted: str = "") -> str:
    """Name of the delete mark: as wanted, by default is_deleted; underscores before it where a column is called so."""
    wanted = wanted or DELETED
    return f"__{wanted}" if wanted in names else wanted


def described(a: Action, database: str = "", deleted: str = "", buckets: int = 0, folders: bool = False) -> Descriptor:
    """The descriptor of a create_table action. Key columns are never null; a table without a key appends.

    buckets: of a keyed table that is to be clustered. folders: by partition columns, if the table isn't clustered and
    their types allow for it.
    """
    key = tuple(map(unquoted, a.key))
    fields = tuple(replace(field_of(c, c.nullable is not False and unquoted(c.name) not in key), stored=unquoted(c.name)) for c in a.columns)
    parts = tuple(map(unquoted, a.partition))
    folders = folders and bool(parts) and not (buckets and key) and all(f.kind in FOLDER_KINDS and f.computed is None for f in fields if f.name in parts)
    return Descriptor(unquoted(a.database or database), unquoted(a.table), fields, key, parts, REPLACING if key else APPEND, mark_name([f.name for f in fields], deleted), serial=1, buckets=buckets if key else 0, folders=folders)


def described_by_schema(database: str, name: str, schema: T.StructType, key: tuple[str, ...] = (), engine: str = REPLACING, deleted: str = "", replicated: bool = False, buckets: int = 0) -> Descriptor:
    """The descriptor of a table made from a record's schema; a key that isn't among its columns is none. deleted: name of the delete mark."""
    key = key if set(key) <= set(schema.names) else ()
    fields = tuple(Field(f.name, f.dataType.simpleString(), f.nullable and f.name not in key, f.name) for f in schema.fields)
    return Descriptor(database, name, fields, key, engine=engine if key else APPEND, deleted=mark_name(schema.names, deleted), serial=1, replicated=replicated, buckets=buckets if key else 0)


def altered(d: Descriptor, a: Action, ts_ms: int | None = None) -> Descriptor:
    """The descriptor after an action on its columns; ts_ms: when it was made."""
    if a.kind == "add_column":
        f = field_of(a.column, a.column.nullable is not False)
        f = replace(f, filled=filling(f, ts_ms))
        return d if f.name in d.columns else d.with_field(f, a.column.place and unquoted(a.column.place))
    if a.kind == "modify_column":
        i = d.index(a.column.name)
        old, rest = d.fields[i], [f for j, f in enumerate(d.fields) if j != i]
        kind = target_type(a.column)[1].simpleString()
        new = replace(old, kind=kind, nullable=a.column.nullable is not False and old.name not in d.key, default=a.column.default)
        serial = d.serial
        if kind != old.kind:
            new, serial = replace(new, stored=f"{old.name}__{serial}", older=((old.stored, old.kind), *old.older)), serial + 1
        place = a.column.place and unquoted(a.column.place)
        at = i if place is None else 0 if place == "first" else [f.name for f in rest].index(place) + 1
        return replace(d, fields=(*rest[:at], new, *rest[at:]), serial=serial)
    if a.kind == "rename_column":
        old, new = map(unquoted, a.names)
        i = d.index(old)
        swap = lambda names: tuple(new if n == old else n for n in names)
        return replace(d, fields=(*d.fields[:i], replace(d.fields[i], name=new), *d.fields[i + 1 :]), key=swap(d.key), partition=swap(d.partition))
    if a.kind == "drop_column":
        i = d.index(a.names[0])
        return replace(d, fields=d.fields[:i] + d.fields[i + 1 :])
    if a.kind == "add_constraint":
        return replace(d, constraints=d.constraints | {unquoted(a.names[0]): a.text})
    if a.kind == "drop_constraint":
        return replace(d, constraints={k: v for k, v in d.constraints.items() if k != unquoted(a.names[0])})
    return d


def arrival() -> list[Column]:
    """What a table's rows are ordered by: version and place. Within a millisecond whole transaction numbers count, as their low bits begin again; without numbers that is the order of versions."""
    return [F.shiftright(VERSION, GTID_BITS), F.col(NUMBER), F.col(VERSION), F.col(SEQ)]


def truncates(log: DataFrame) -> DataFrame:
    """(_place, _seq, _ts) of the last truncate of each place."""
    return log.where(TRUNCATE).groupBy(PLACE).agg(F.max(SEQ).alias(SEQ), F.max(TIME).alias(TIME))


def after_truncates(log: DataFrame) -> DataFrame:
    """Rows after all truncates: by offset where both come from one place, else by the source's time (by offset where that is unknown).

    The truncates are one row a topic partition; they join as one array.
    """
    cuts = truncates(log).agg(F.collect_list(F.struct(F.col(PLACE).alias("place"), F.col(SEQ).alias("seq"), F.col(TIME).alias("ts"))).alias("__cuts"))
    rows = log.where(f"NOT coalesce({TRUNCATE}, false)").join(F.broadcast(cuts))
    return rows.where(f"forall(__cuts, c -> CASE WHEN c.place <=> {PLACE} THEN {SEQ} > c.seq ELSE coalesce({TIME} >= c.ts, {SEQ} > c.seq) END)").drop("__cuts")


class Warehouse:
    """Databases and tables below a folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.files = spark, root.rstrip("/"), Files(spark)
        self.lost: Counter[tuple[str, str]] = Counter()  # values by table that did not fit their column and became null
        self.broken: Counter[tuple[str, str, str]] = Counter()  # rows by table and constraint that break it

    def databases(self) -> list[str]:
        return [n for n in self.files.names(self.root) if not n.startswith("_")]

    def folder(self, database: str, name: str) -> str:
        return f"{self.root}/{database}/{name}"

    def exists(self, database: str, name: str) -> bool:
        return self.files.exists(f"{self.folder(database, name)}/descriptor.json")

    def tables(self, database: str) -> list[str]:
        return [n for n in self.files.names(f"{self.root}/{database}") if self.exists(database, n)]

    def load(self, database: str, name: str) -> Descriptor:
        if not self.exists(database, name):
            raise KeyError(f"there is no table {database}.{name}")
        return Descriptor.from_json(self.files.read(f"{self.folder(database, name)}/descriptor.json"))

    def save(self, d: Descriptor) -> None:
        self.files.write(f"{self.folder(d.database, d.name)}/descriptor.json", d.to_json())

    def execute(self, actions: list[Action], database: str = "", override: dict[str, str] | None = None, seq: int | None = None, place: str | None = None, ts_ms: int | None = None, deleted: str = "", buckets: int = 0, folders: bool = False) -> None:
        """Actions in order.

        seq: offset in the log. A table's column changes at or before the offset of its last one were made
        already and are passed over, so a repeated batch is harmless. place, ts_ms: topic/partition and
        time; truncates cut there. deleted, buckets, folders: delete mark and layout of tables that are made.
        """
        override, fresh = override or {}, {}
        db_of = lambda db: override.get(unquoted(db or database), unquoted(db or database))
        self.check_renames([(db_of(a.database), unquoted(a.table), db_of(a.names[0]), unquoted(a.names[1])) for a in actions if a.kind == "rename_table"])
        for a in actions:
            db, name = db_of(a.database), unquoted(a.table) if a.table else ""
            if a.kind == "create_database":
                self.files.make(f"{self.root}/{db}")
                continue
            if a.kind == "create_table":
                if not self.exists(db, name):
                    self.save(replace(described(a, database, deleted, buckets, folders), database=db))
            elif a.kind == "create_like":
                other = self.load(db_of(a.names[0]), unquoted(a.names[1]))
                if not self.exists(db, name):
                    self.save(replace(other, database=db, name=name, data="data-0"))
            elif a.kind == "drop_table":
                self.files.delete(self.folder(db, name))
            elif a.kind == "rename_table":
                new_db, new = db_of(a.names[0]), unquoted(a.names[1])
                if self.exists(db, name) and (db, name) != (new_db, new):
                    self.files.rename(self.folder(db, name), self.folder(new_db, new))
                    self.save(replace(self.load(new_db, new), database=new_db, name=new))
            elif a.kind == "truncate":
                self.truncate(self.load(db, name), seq, place, ts_ms)
            else:
                d = self.load(db, name)
                changed = a.names[:1] if a.kind == "drop_column" else (a.column.name,) if a.kind == "modify_column" else ()
                if d.folders and set(map(unquoted, changed)) & set(d.partition):  # folders hold the old values
                    self.compact(db, name, folders=False)
                    d = self.load(db, name)
                if fresh.setdefault((db, name), seq is None or d.applied < seq):
                    self.save(replace(altered(d, a, ts_ms), applied=d.applied if seq is None else seq))

    def check_renames(self, moves: list[tuple[str, str, str, str]]) -> None:
        """All moves of a statement are made or none: DdlError if one leads onto a table that is there by then."""
        there: dict[tuple[str, str], bool] = {}
        known = lambda t: there.setdefault(t, self.exists(*t))
        for db, name, new_db, new in moves:
            if (db, name) != (new_db, new) and known((db, name)):
                if known((new_db, new)):
                    raise DdlError(f"{db}.{name} can't be renamed: there is a table {new_db}.{new}")
                there[db, name], there[new_db, new] = False, True

    def truncate(self, d: Descriptor, seq: int | None, place: str | None = None, ts_ms: int | None = None) -> None:
        """A marker in the log: rows before it are gone, see after_truncates(). Without an offset, all data so far."""
        if seq is None:
            self.save(replace(d, data=f"data-{int(d.data.split('-')[1]) + 1}"))
            return
        row = self.spark.range(1).select(F.lit(None).cast("bigint").alias(VERSION), F.lit(seq).cast("bigint").alias(SEQ), F.lit(True).alias(TRUNCATE), F.lit(place).cast("string").alias(PLACE), F.lit(ts_ms).cast("bigint").alias(TIME))
        self.append(d, row, f"truncate-{seq}" if place is None else f"truncate-{seq}-{hashlib.md5(place.encode()).hexdigest()[:8]}")

    def append(self, d: Descriptor, rows: DataFrame, batch: str | dict[int, str], merged: bool = False, most: int = 0) -> None:
        """Rows by logical name, with _version, _seq and the delete mark.

        A batch that is there in whole is left as it is: it was written by the columns of its time. Files
        are sorted by the partition columns and the key, so that readers can skip row groups. Values that
        don't fit their column are counted in `lost`, live rows that break a CHECK constraint in `broken`; they
        are written all the same, since the source has let them in. Both are observed while the rows are written.
        merged: rows of older runs, dealt out by key already; they were counted when they came.

        batch: a name, or the names of the parts that the rows have in a column of its own, of `most` rows at most.
        All parts that aren't there are written by one job, aside, and then moved into their places.
        """
        data = f"{self.folder(d.database, d.name)}/{d.data}"
        names, gone = {None: batch} if isinstance(batch, str) else batch, self.superseded(d) if d.buckets else set()
        new = {n: b for n, b in names.items() if f"batch={b}" not in gone and not self.files.exists(f"{data}/batch={b}/_SUCCESS")}
        if not new:
            return
        cut = None not in new
        path = f"{data}/_aside-{uuid.uuid4().hex}" if cut else f"{data}/batch={batch}"
        if len(new) < len(names):
            rows = rows.where(F.col(PART).isin(list(new)))
        if cut and not d.buckets:
            spread = [F.pmod(F.xxhash64(SEQ, *[c for c in d.key if c in rows.columns]), F.lit(-(-most // TASK_ROWS)))] if most > TASK_ROWS else []
            rows = rows.repartition(PART, *spread)
        more = [PART] if cut else []
        own = [f for f in d.fields if f.computed is None]
        logical = T.StructType([T.StructField(n, T._parse_datatype_string(k)) for n, k in [*((f.name, f.kind) for f in own), *d.extras()]])
        # a column that the rows don't have takes its default
        absent = {f.name: literal_of(text, f.kind) for f in own if f.name not in (*rows.columns, *d.key) and (text := filling(f, None)) is not None}
        rows = rows.withColumns({**absent, SCHEMA: F.lit(d.serial)})
        if (misfits := unfit(rows, logical)) is not None:
            rows = rows.withColumn(LOST, misfits)
        fit = align(rows, T.StructType([*logical.fields, *[T.StructField(c, T.IntegerType()) for c in more], *([T.StructField(LOST, T.LongType())] if misfits is not None else [])]))
        rules = {n: v for n, rule in ({} if merged else d.constraints).items() if (v := self.violation(fit, d, rule)) is not None}
        counted = ([F.col(LOST)] if misfits is not None else []) + list(rules.values())
        watch = Observation(f"append-{uuid.uuid4().hex}") if counted else None
        if watch is not None:
            fit = fit.observe(watch, *[F.coalesce(F.sum(c), F.lit(0)).alias(f"n{i}") for i, c in enumerate(counted)])
        out = fit.select(*logical.names, *more).toDF(*[f.stored for f in own], *[n for n, _ in d.extras()], *more)
        by_name = {f.name: f.stored for f in own}
        if d.buckets:
            self.write_buckets(d, out, path, [by_name[c] for c in d.key], merged, more)
        else:
            order = [*more, *[f"`{by_name[c]}`" for c in (*d.partition, *d.key) if c in by_name]]
            writer = (out.sortWithinPartitions(*order) if order else out).write.mode("overwrite")
            folders = [*more, *([by_name[c] for c in d.partition] if d.folders else [])]
            (writer.partitionBy(*folders) if folders else writer).parquet(path)
        if cut:
            self.place_parts(data, path, new)
        if watch is not None:
            found = [watch.get.get(f"n{i}") or 0 for i in range(len(counted))]
            if misfits is not None:
                self.lost[d.database, d.name] += found.pop(0)
            for name, n in zip(rules, found):
                self.broken[d.database, d.name, name] += n

    def place_parts(self, data: str, aside: str, names: dict[int, str]) -> None:
        """Move the parts that were written aside to the batches that they are; each is whole from then on."""
        there = set(self.files.names(aside))
        for n, batch in names.items():
            if (part := f"{PART}={n}") not in there:  # no row of it was left
                self.files.write(f"{data}/batch={batch}/_SUCCESS", "")
                continue
            self.files.touch(f"{aside}/{part}/_SUCCESS")
            self.files.delete(f"{data}/batch={batch}")  # what a job that did not end left behind
            self.files.rename(f"{aside}/{part}", f"{data}/batch={batch}")
        self.files.delete(aside)

    def write_buckets(self, d: Descriptor, out: DataFrame, path: str, key: list[str], placed: bool, parts: list[str]) -> None:
        """Files of one bucket each, sorted by the key. Spark writes buckets for a table of its catalog, which is forgotten at once."""
        if not placed:
            out = out.repartition(d.buckets, *[F.col(f"`{k}`") for k in key])
        name = f"driftwell_{uuid.uuid4().hex}"
        self.files.delete(path)
        writer = out.write.format("parquet").bucketBy(d.buckets, *key).sortBy(*key).option("path", path)
        (writer.partitionBy(*parts) if parts else writer).saveAsTable(name)
        self.spark.sql(f"DROP TABLE {name}")

    def superseded(self, d: Descriptor) -> set[str]:
        """Runs that are part of a merged one."""
        path = f"{self.folder(d.database, d.name)}/{d.data}"
        whole = [n for n in self.files.names(path) if n.startswith("batch=tier") and self.files.exists(f"{path}/{n}/_SUCCESS")]
        return {run for n in whole for run in json.loads(self.files.read(f"{path}/inputs/{n}.json"))}

    def runs(self, d: Descriptor) -> list[str]:
        """Names of the runs that make up a table."""
        path = f"{self.folder(d.database, d.name)}/{d.data}"
        found = [n for n in self.files.names(path) if n.startswith("batch=")]
        if not d.buckets:
            return found
        gone = self.superseded(d)
        return [n for n in found if n not in gone and self.files.exists(f"{path}/{n}/_SUCCESS")]

    def clustered(self, d: Descriptor, runs: list[str]) -> DataFrame | None:
        """The runs as one bucketed table; None where files of an older key column have other buckets."""
        key = [f for f in d.fields if f.name in d.key]
        if any(f.older for f in key):
            return None
        path = f"{self.folder(d.database, d.name)}/{d.data}"
        name = f"driftwell_{hashlib.md5(json.dumps([path, d.serial, runs]).encode()).hexdigest()}"
        if not self.spark.catalog.tableExists(name):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in d.stored_schema().fields)
            names = ", ".join(f"`{f.stored}`" for c in d.key for f in key if f.name == c)
            self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}, {RUN} STRING) USING parquet PARTITIONED BY ({RUN}) CLUSTERED BY ({names}) SORTED BY ({names}) INTO {d.buckets} BUCKETS LOCATION '{path}'")
            parts = " ".join(f"PARTITION ({RUN} = '{n}') LOCATION '{path}/{n}'" for n in runs)
            self.spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {parts}")
        return self.spark.table(name).drop(RUN)

    def violation(self, rows: DataFrame, d: Descriptor, rule: str) -> Column | None:
        """1 for a live row that breaks the rule (which null does not), else 0; None for a rule that Spark can't read."""
        live = f"NOT coalesce({TRUNCATE}, false)" + ("" if d.engine == COLLAPSING else f" AND coalesce(`{d.deleted}`, 0) = 0")
        try:
            broken = F.expr(f"CASE WHEN {live} AND NOT ({rule}) THEN 1L ELSE 0L END")
            rows.select(broken)
        except (AnalysisException, ParseException):
            return None
        return broken

    def log(self, d: Descriptor, runs: list[str] | None = None) -> DataFrame:
        """All rows by logical name, or those of some runs, not cut or resolved."""
        path, schema = f"{self.folder(d.database, d.name)}/{d.data}", d.stored_schema()
        found = self.runs(d) if runs is None else runs
        raw = self.clustered(d, found) if d.buckets and found else None
        if raw is None:
            raw = self.spark.read.schema(schema).option("basePath", path).parquet(*[f"{path}/{n}" for n in found]) if found else self.spark.createDataFrame([], schema)

        def value(f: Field):
            kinds = [F.col(f"`{f.stored}`"), *[F.col(f"`{n}`").try_cast(f.kind) for n, _ in f.older]]
            if f.filled is None:
                return F.coalesce(*kinds).alias(f.name)
            return F.when(F.coalesce(F.col(SCHEMA), F.lit(0)) < f.since, literal_of(f.filled, f.kind)).otherwise(F.coalesce(*kinds)).alias(f.name)

        plain = raw.select(*[value(f) for f in d.fields if f.computed is None], *[n for n, _ in d.extras()])
        for f in d.fields:
            if f.computed is not None:
                plain = plain.withColumn(f.name, F.expr(f.computed).try_cast(f.kind))
        return plain.select(*d.columns, *[n for n, _ in d.extras()])

    def state(self, d: Descriptor) -> DataFrame:
        """Live rows of the table."""
        rows = after_truncates(self.log(d)).drop(TRUNCATE, PLACE, TIME, SCHEMA)
        if d.engine == COLLAPSING:
            rows = collapse(rows, list(d.key), arrival())
        elif d.engine == REPLACING:
            rows = (latest_by_column if d.partial else latest)(rows, list(d.key), arrival()).where(F.col(d.deleted) == 0)
        else:
            rows = rows.where(f"coalesce(`{d.deleted}`, 0) = 0")
        return rows.select(*d.columns)

    def resolved(self, d: Descriptor, log: DataFrame) -> DataFrame:
        """What a log of rows comes to: the last row of each key, with its version, of partial images all that may be needed. Deletes and truncates stay as marks, so that a late row from before them stays gone."""
        rows = after_truncates(log)
        kept = (needed_by_column if d.partial else latest)(rows, list(d.key), arrival()) if d.engine == REPLACING else collapse(rows, list(d.key), arrival()) if d.engine == COLLAPSING else rows
        return kept.unionByName(truncates(log).withColumn(TRUNCATE, F.lit(True)), allowMissingColumns=True)

    def compact(self, database: str, name: str, buckets: int | None = None, folders: bool | None = None) -> None:
        """The log replaced by what it comes to; readers of the old folder are not disturbed. buckets: cluster the table anew, 0 for not at all. folders: by partition, or none."""
        d = self.load(database, name)
        new = replace(d, data=f"data-{int(d.data.split('-')[1]) + 1}", buckets=d.buckets if buckets is None or not d.key else buckets, folders=d.folders if folders is None else folders)
        new = replace(new, folders=new.folders and not new.buckets)
        self.append(new, self.resolved(d, self.log(d)), "compacted", merged=new.buckets == d.buckets)
        self.save(new)

    def merge(self, database: str, name: str, tier: int = TIER) -> int:
        """Merge runs of a clustered replacing table while there are `tier` of one tier; the number of runs that were read.

        The merged run counts from when it is whole; runs that it took in are deleted at the next merge, so
        that their readers come to an end. Rows are never moved between buckets.
        """
        d, merged = self.load(database, name), 0
        if not d.buckets or d.engine != REPLACING or any(f.older for f in d.fields if f.name in d.key):
            return 0
        path = f"{self.folder(database, name)}/{d.data}"
        while True:
            by_tier: dict[int, list[str]] = {}
            for n in self.runs(d):
                by_tier.setdefault(int(n[len("batch=tier") :].partition("-")[0]) if n.startswith("batch=tier") else 0, []).append(n)
            full = [(t, sorted(own)) for t, own in sorted(by_tier.items()) if len(own) >= tier]
            if not full:
                return merged
            at, own = full[0]
            done, batch = self.superseded(d), f"tier{at + 1}-{hashlib.md5(json.dumps(own).encode()).hexdigest()}"
            self.files.write(f"{path}/inputs/batch={batch}.json", json.dumps(own))
            self.append(d, self.resolved(d, self.log(d, own)), batch, merged=True)
            for n in done:
                self.files.delete(f"{path}/{n}")
            merged += len(own)

    def tidy(self, database: str, name: str, most: int) -> None:
        """Compact a replacing table of more than `most` batches, or merge runs of a clustered one; a batch that comes again after that changes nothing."""
        d = self.load(database, name)
        if d.buckets:
            self.merge(database, name, min(most, TIER))
        elif d.engine == REPLACING and len(self.files.names(f"{self.folder(database, name)}/{d.data}")) > most:
            self.compact(database, name)

    def evolve(self, d: Descriptor, schema: T.StructType) -> Descriptor:
        """d with the record's new columns added."""
        for f in missing_columns(schema, d.schema()):
            d = d.with_field(Field(f.name, f.dataType.simpleString()))
        self.save(d)
        return d
