"""Settings of a replication, by the keys that users know; each with its default."""

from __future__ import annotations

from dataclasses import dataclass, field, fields
from zoneinfo import ZoneInfo

from ..operators.dedup import POLICIES
from .routing import parse_map


def flag(value: object) -> bool:
    return value if isinstance(value, bool) else str(value).strip().lower() == "true"


@dataclass(frozen=True)
class Settings:
    """zone: of zoneless times. max_records: most records that are written at once; larger batches are cut, 0 for never. buffer_count: distinct keys a topic that
    deduplication remembers. snapshot_mode: schema_only or no_data leaves out the rows of snapshots. compact_after: batches of a replacing table that lie side by side at most, 0 for any number.
    dialect: postgres orders changes by log sequence number, and its images may leave unchanged texts out.
    buckets: new tables with a key are clustered in so many buckets, 0 for none. folders: other new tables have a folder for each value of their partition columns."""

    ignore_delete: bool = False
    deduplication_policy: str = "off"
    buffer_count: int = 100
    topics: dict[str, str] = field(default_factory=dict)
    databases: dict[str, str] = field(default_factory=dict)
    store_metadata: bool = False
    store_raw: bool = False
    raw_column: str = ""
    delete_column: str = "sign"
    auto_create: bool = False
    evolve: bool = False
    snowflake: bool = True
    raw_bytes: bool = False
    zone: str = ""
    disable_ddl: bool = False
    disable_drop_truncate: bool = False
    snapshot_ddl: bool = False
    ddl_retry: bool = False
    single_threaded: bool = False
    flush_ms: int = 30
    replicated: bool = False
    store_offsets: bool = False
    compact_after: int = 200
    snapshot_mode: str = "initial"
    max_records: int = 100_000
    autostart: bool = True
    buckets: int = 0
    dialect: str = "mysql"
    folders: bool = False

    @classmethod
    def of(cls, given: dict[str, object]) -> Settings:
        """From configuration keys; unknown keys are ignored, bad values raise ValueError."""
        kinds = {f.name: f.type for f in fields(cls)}
        out: dict[str, object] = {}
        for key, value in given.items():
            name = KEYS.get(key) or KEYS.get(key.partition(".")[2])  # some keys have the target's name before them
            if name is None:
                continue
            if name in ("topics", "databases"):
                out[name] = parse_map(str(value), check_values=name == "databases")
            elif kinds[name] == "bool":
                out[name] = flag(value) != (key in NEGATED)
            elif kinds[name] == "int":
                out[name] = int(value)
                if out[name] < 0:
                    raise ValueError(f"{key} is negative")
            else:
                out[name] = str(value)
        policy = out["deduplication_policy"] = str(out.get("deduplication_policy", "off")).lower()
        if policy not in POLICIES:
            raise ValueError(f"deduplication.policy is one of {POLICIES}")
        if out.get("dialect", "mysql") not in DIALECTS:
            raise ValueError(f"source.dialect is one of {DIALECTS}")
        if out.get("zone"):
            ZoneInfo(out["zone"])
        return cls(**out)


#: Keys of the settings, without the prefix that names the target.
KEYS = {
    "ignore_delete": "ignore_delete", "deduplication.policy": "deduplication_policy", "buffer.count": "buffer_count",
    "topic2table.map": "topics", "database.override.map": "databases", "store.kafka.metadata": "store_metadata",
    "store.raw.data": "store_raw", "store.raw.data.column": "raw_column", "replacingmergetree.delete.column": "delete_column",
    "auto.create.tables": "auto_create", "schema.evolution": "evolve", "snowflake.id": "snowflake", "persist.raw.bytes": "raw_bytes",
    "datetime.timezone": "zone", "disable.ddl": "disable_ddl", "disable.drop.truncate": "disable_drop_truncate",
    "enable.snapshot.ddl": "snapshot_ddl", "ddl.retry": "ddl_retry", "single.threaded": "single_threaded",
    "buffer.flush.time.ms": "flush_ms", "buffer.max.records": "max_records", "skip_replica_start": "autostart",
    "auto.create.tables.replicated": "replicated", "enable.kafka.offset": "store_offsets", "compact.after.batches": "compact_after",
    "snapshot.mode": "snapshot_mode", "cluster.buckets": "buckets", "source.dialect": "dialect", "partition.folders": "folders",
}
DIALECTS = ("mysql", "mariadb", "postgres")
NEGATED = ("skip_replica_start",)
