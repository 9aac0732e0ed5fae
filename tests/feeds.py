"""Small feeds, and their expected results worked out event by event in plain Python."""

from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import DataFrame, SparkSession

START = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
SCHEMA = (
    "k int, v int, _raw_change_type string, _raw_commit_timestamp timestamp, _raw_commit_version long, n int"
)
Event = tuple[int, int, str, int, int, int]


def at(minute: int) -> dt.datetime:
    return START + dt.timedelta(minutes=minute)


def random_events(seed: int, keys: int = 12, count: int = 400, minutes: int = 90) -> list[Event]:
    """(key, value, kind, minute, version, number); key 0 gets a third of the events."""
    rng = random.Random(seed)
    events = []
    for number in range(count):
        key = 0 if rng.random() < 1 / 3 else rng.randrange(1, keys)
        kind = rng.choice(("insert", "update", "update", "delete"))
        minute = rng.randrange(minutes)
        events.append((key, rng.randrange(1000), kind, minute, minute // 10, number))
    return events


def frame(spark: SparkSession, events: list[Event]) -> DataFrame:
    rows = [(k, v, kind, at(m), version, n) for k, v, kind, m, version, n in events]
    return spark.createDataFrame(rows, SCHEMA)


def survivors(events: list[Event]) -> dict[int, list[Event]]:
    """Per key, in time order, the event that counts at each minute."""
    found: dict[int, dict[int, Event]] = {}
    for event in sorted(events, key=lambda e: (e[3], e[4], e[5], e[2] != "delete")):
        found.setdefault(event[0], {})[event[3]] = event
    return {key: [points[m] for m in sorted(points)] for key, points in found.items()}


def expected_scd1(events: list[Event]) -> set[tuple]:
    last = [chain[-1] for chain in survivors(events).values()]
    return {(e[0], e[1], e[5]) for e in last if e[2] != "delete"}


def expected_scd2(events: list[Event]) -> set[tuple]:
    versions = set()
    for chain in survivors(events).values():
        for event, following in zip(chain, [*chain[1:], None]):
            if event[2] != "delete":
                versions.add((event[0], event[1], event[5], event[3], following and following[3]))
    return versions


def minute(moment: dt.datetime | None) -> int | None:
    if moment is None:
        return None
    return int((moment - START.replace(tzinfo=None)).total_seconds() // 60)


def as_scd1(rows: DataFrame) -> set[tuple]:
    return {(r["k"], r["v"], r["n"]) for r in rows.collect()}


def as_scd2(rows: DataFrame) -> set[tuple]:
    found = [
        (r["k"], r["v"], r["n"], minute(r["__START_AT"]), minute(r["__END_AT"])) for r in rows.collect()
    ]
    assert len(found) == len(set(found))
    return set(found)
