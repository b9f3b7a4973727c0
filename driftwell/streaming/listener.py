"""Figures of running queries, kept by name and given out as text."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from ..operators.metrics import figures, topic_counts


class Metrics(StreamingQueryListener):
    """Counters and gauges. attach() follows the queries of a session; observe() takes a batch of events."""

    def __init__(self):
        self.values: dict[tuple[str, tuple[tuple[str, str], ...]], float] = {}
        self.began = time.time()

    def attach(self, spark: SparkSession) -> Metrics:
        spark.streams.addListener(self)
        return self

    def set(self, name: str, value: float | None, **labels: object) -> None:
        if value is not None:
            self.values[name, tuple(sorted((k, str(v)) for k, v in labels.items()))] = float(value)

    def top(self, name: str, value: float | None, **labels: object) -> None:
        """set(), unless the figure is greater already: batches may come out of order."""
        if value is not None:
            self.set(name, max(value, self.values.get((name, tuple(sorted((k, str(v)) for k, v in labels.items()))), value)), **labels)

    def add(self, name: str, value: float, **labels: object) -> None:
        key = name, tuple(sorted((k, str(v)) for k, v in labels.items()))
        self.values[key] = self.values.get(key, 0.0) + value

    def observe(self, events: DataFrame, records: DataFrame, now_ms) -> None:
        """Figures of one batch, in two jobs; a row a topic and partition comes to the driver."""
        for r in topic_counts(events).collect():
            self.add("records_total", r.records or 0, topic=r.topic)
            self.add("errors_total", r.errors or 0, topic=r.topic)
            self.add("ddl_total", r.ddl or 0, topic=r.topic)
        self.take(records.groupBy("topic", "partition").agg(*figures(now_ms)).collect())

    def take(self, rows: list) -> None:
        """Figures of topic partitions that another job has gathered, with figures() among its aggregates."""
        place = lambda r: (r.at.ts_ms or 0, r.at.offset or 0)
        for r in rows:
            self.top("partition_offset", r.max_offset, topic=r.topic, partition=r.partition)
        for topic in {r.topic for r in rows}:
            own = [x for x in rows if x.topic == topic]
            r = max(own, key=place)
            for name, put in (("source_lag_ms", self.set), ("cdc_lag_ms", self.set), ("max_gtid", self.top)):
                put(name, max((x[name] for x in own if x[name] is not None), default=None), topic=topic)
            self.top("binlog_position", max((x.max_pos for x in own if x.max_pos is not None), default=None), topic=topic, file=r.last_file)

    def text(self) -> str:
        """A line a figure: name{labels} value."""
        self.set("uptime_seconds", round(time.time() - self.began))
        shown = lambda labels: "{" + ",".join(f'{k}="{v}"' for k, v in labels) + "}" if labels else ""
        return "".join(f"{name}{shown(labels)} {int(value) if value.is_integer() else value}\n" for (name, labels), value in sorted(self.values.items()))

    def onQueryStarted(self, event) -> None:
        self.add("queries_started", 1)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.add("input_rows_total", p.numInputRows)
        self.set("last_batch", p.batchId)
        self.set("batch_ms", (p.durationMs or {}).get("triggerExecution"))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.add("queries_ended", 1)
        if event.exception:
            self.add("queries_failed", 1)
