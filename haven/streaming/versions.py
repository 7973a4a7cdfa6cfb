"""Client history on the stream: versions as soon as the watermark has passed their instant.

Case updates are kept per client until no earlier event can come any more.
Then the instant is settled as the batch history does it: several updates of one
field at one instant collapse to the last by event id, an update equal to the
field's previous value is a no-op, and every instant with an effective change is
the client's next version.  The open updates of a client are bounded by the
lateness allowed; what stays for good is one value a field and the number of
versions.  Spark's state store (RocksDB) holds both, so a restart goes on where
the last run stopped.

Order within a client is the point of a version, so one client is one key; its
state is small whatever the length of its history.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from itertools import groupby

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from haven import contracts as C

#: Times cross into the processor as microseconds, which have no time zone.
VERSIONS = ("client_id_hash string, at long, version int, field_changed string, new_value string, prev_value string, "
            "event_id string, " + ", ".join(f"{f} string" for f in C.CASE_FIELDS))


class ClientVersions(StatefulProcessor):
    """Settles each client's instants in order."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getMapState("open", "at long, field string", "id string, value string")
        self.last = handle.getMapState("last", "field string", "value string, shown string")
        self.versions = handle.getValueState("versions", "n int")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        # the batch's own last update an instant and field first: every call on the state crosses to the JVM
        newest: dict[tuple, tuple] = {}
        for r in rows:
            if r.op not in C.CASE_OPS or r.at is None:
                continue
            at = (r.at, r.field_changed)
            if at not in newest or (r.event_id or "") > (newest[at][0] or ""):
                newest[at] = (r.event_id, r.new_value)
        for at, update in newest.items():
            held = self.open.getValue(at) if self.open.containsKey(at) else None
            if held is None or (update[0] or "") > (held[0] or ""):
                self.open.updateValue(at, update)
        # once the watermark is past its millisecond the instant is complete
        for ms in {at // 1000 + 1 for at, _ in newest}:
            self.handle.registerTimer(ms)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        # the first of a client's timers settles all that the watermark has passed: the open updates are
        # read once, not once a timer
        until, passed = expiredTimerInfo.getExpiryTimeInMs() * 1000, timerValues.getCurrentWatermarkInMs()
        due = sorted(((k[0], k[1], v[0], v[1]) for k, v in self.open.iterator() if k[0] < until or k[0] // 1000 + 1 < passed),
                     key=lambda x: (x[0], x[1] or ""))
        if not due:
            return
        last = {k[0]: (v[0], v[1]) for k, v in self.last.iterator()}
        n = self.versions.get()[0] if self.versions.exists() else 1  # the base row is version 1
        for at, changes in groupby(due, key=lambda x: x[0]):
            effective = []
            for _, field, event, value in changes:
                self.open.removeKey((at, field))
                before, shown = last.get(field, (None, None))
                if before is None or (value is not None and before != value):
                    effective.append((field, value, before, event))
                    shown = shown if value is None else value
                last[field] = (value, shown)
            if effective:
                n += 1
                now = [last.get(f, (None, None))[1] for f in C.CASE_FIELDS]
                for field, value, before, event in effective:
                    yield Row(client_id_hash=key[0], at=at, version=n, field_changed=field, new_value=value, prev_value=before,
                              event_id=event, **dict(zip(C.CASE_FIELDS, now, strict=True)))
        for field in {x[1] for x in due}:
            self.last.updateValue((field,), last[field])
        self.versions.update((n,))


def client_versions(parsed: DataFrame) -> DataFrame:
    """One row per effective change, with the client's version and values from that instant on.

    ``parsed``: case updates with a hashed client id and a watermark on event_time."""
    rows = parsed.select("client_id_hash", "op", "field_changed", "new_value", "event_id", "event_time",
                         F.unix_micros("event_time").alias("at"))
    settled = rows.groupBy("client_id_hash").transformWithState(ClientVersions(), VERSIONS, "Append", "EventTime")
    return settled.select("client_id_hash", F.timestamp_micros("at").alias("valid_from"), "version", "field_changed", "new_value",
                          "prev_value", "event_id", *C.CASE_FIELDS)


@contextmanager
def rocksdb_state(spark: SparkSession):
    """Queries started inside keep their state in RocksDB, which timers and map state need."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(name, before)
