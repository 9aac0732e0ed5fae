from __future__ import annotations

import random
from functools import partial
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests import feeds
from tidemark.operators.scd import IS_DELETE, event_intervals, scd1_events
from tidemark.operators.skew import hot_keys
from tidemark.sources.storage import partition_values
from tidemark.sources.streams import stream_path
from tidemark.streaming import history
from tidemark.streaming.ledger import append_changes, buckets_for, forget_batches, is_dealt, read_batches
from tidemark.streaming.triggered import finish

TIES = ("n",)


def land(spark, folder, events, number, **dealt):
    """Give the stream a further file and let it run."""
    feeds.frame(spark, events).coalesce(1).write.parquet(f"{folder}/landing/part={number}")
    schema = f"{feeds.SCHEMA}, part int"
    stream = stream_path(spark, f"{folder}/landing", spark.createDataFrame([], schema).schema)
    return finish(append_changes(stream.drop("part"), f"{folder}/ledger", f"{folder}/checkpoint", **dealt))


def parts_of(events, order):
    """Events cut into parts that arrive in time order or mixed."""
    if order == "mixed":
        events = random.Random(0).sample(events, len(events))
    else:
        events = sorted(events, key=lambda e: e[3])
    size = len(events) // 3 + 1
    return [events[i : i + size] for i in range(0, len(events), size)]


@pytest.mark.parametrize("order", ["in time", "mixed"])
def test_refreshed_tables_equal_the_batch_result(spark, folder, order):
    events = feeds.random_events(11, count=240, minutes=2000)
    seen = []
    for number, part in enumerate(parts_of(events, order)):
        land(spark, folder, part, number)
        seen += part
        ledger = f"{folder}/ledger"
        assert history.refresh_scd2(spark, ledger, f"{folder}/two", ["k"], tie_break=TIES, hot_rows=30)
        assert history.refresh_scd1(spark, ledger, f"{folder}/one", ["k"], tie_break=TIES)
        versions = history.read_scd2(spark, f"{folder}/two", ["k"])
        assert feeds.as_scd2(versions) == feeds.expected_scd2(seen)
        assert feeds.as_scd1(history.read_scd1(spark, f"{folder}/one")) == feeds.expected_scd1(seen)
    assert feeds.as_scd1(history.read_current(spark, f"{folder}/two")) == feeds.expected_scd1(events)


def test_files_are_compressed_by_entropy(spark, folder):
    """Keys in no order shrink little otherwise: ledger, last events, ended events and touched keys."""
    land(spark, folder, feeds.random_events(5, count=80), 0)
    history.refresh_scd2(spark, f"{folder}/ledger", f"{folder}/two", ["k"], tie_break=TIES)
    for place in ("ledger", "two/latest", "two/events", "two/touched"):
        files = list(Path(f"{folder}/{place}").rglob("*.parquet"))
        assert files and all(file.name.endswith(".zstd.parquet") for file in files)


def test_compacted_table_goes_on(spark, folder):
    events = feeds.random_events(17, count=180, minutes=2000)
    old, new = f"{folder}/two", f"{folder}/compact"
    for number, part in enumerate([events[:60], events[60:120], events[120:]]):
        land(spark, folder, part, number)
        if number < 2:
            history.refresh_scd2(spark, f"{folder}/ledger", old, ["k"], tie_break=TIES)
    history.compact_scd2(spark, old, new, ["k"])
    assert feeds.as_scd2(history.read_scd2(spark, new, ["k"])) == feeds.expected_scd2(events[:120])
    assert history.refresh_scd2(spark, f"{folder}/ledger", new, ["k"], tie_break=TIES)
    assert feeds.as_scd2(history.read_scd2(spark, new, ["k"])) == feeds.expected_scd2(events)


def test_nothing_new_means_no_refresh(spark, folder):
    assert not history.refresh_scd2(spark, f"{folder}/ledger", f"{folder}/two", ["k"])
    events = feeds.random_events(12, count=60)
    land(spark, folder, events, 0)
    assert history.refresh_scd2(spark, f"{folder}/ledger", f"{folder}/two", ["k"], tie_break=TIES)
    assert land(spark, folder, [], 1) == 0
    assert not history.refresh_scd2(spark, f"{folder}/ledger", f"{folder}/two", ["k"], tie_break=TIES)


def test_events_delivered_again_change_nothing(spark, folder):
    events = feeds.random_events(13, count=120)
    for number, part in enumerate([events, events[30:90]]):
        land(spark, folder, part, number)
        history.refresh_scd2(spark, f"{folder}/ledger", f"{folder}/two", ["k"], tie_break=TIES)
        history.refresh_scd1(spark, f"{folder}/ledger", f"{folder}/one", ["k"], tie_break=TIES)
    versions = history.read_scd2(spark, f"{folder}/two", ["k"])
    assert feeds.as_scd2(versions) == feeds.expected_scd2(events)
    assert feeds.as_scd1(history.read_scd1(spark, f"{folder}/one")) == feeds.expected_scd1(events)


def test_interrupted_refresh_is_made_good(spark, folder, monkeypatch):
    events = sorted(feeds.random_events(14, count=200), key=lambda e: e[3])
    ledger, table = f"{folder}/ledger", f"{folder}/two"
    land(spark, folder, events[:80], 0)
    history.refresh_scd2(spark, ledger, table, ["k"], tie_break=TIES)
    land(spark, folder, events[80:140], 1)

    with monkeypatch.context() as broken:
        def stop(*_):
            raise RuntimeError("lost")

        broken.setattr(history._Table, "finish", stop)
        with pytest.raises(RuntimeError):
            history.refresh_scd2(spark, ledger, table, ["k"], tie_break=TIES)
    assert feeds.as_scd2(history.read_scd2(spark, table, ["k"])) == feeds.expected_scd2(events[:80])

    land(spark, folder, events[140:], 2)
    history.refresh_scd2(spark, ledger, table, ["k"], tie_break=TIES)
    assert feeds.as_scd2(history.read_scd2(spark, table, ["k"])) == feeds.expected_scd2(events)


def test_late_older_event_does_not_revive_a_deleted_key(spark, folder):
    ledger = f"{folder}/ledger"
    for number, event in enumerate([(1, 5, "delete", 50, 5, 0), (1, 4, "update", 20, 2, 1)]):
        land(spark, folder, [event], number)
        history.refresh_scd1(spark, ledger, f"{folder}/one", ["k"])
        history.refresh_scd2(spark, ledger, f"{folder}/two", ["k"])
        assert history.read_scd1(spark, f"{folder}/one").count() == 0
    versions = history.read_scd2(spark, f"{folder}/two", ["k"])
    assert feeds.as_scd2(versions) == {(1, 4, 1, 20, 50)}


def test_null_is_a_key_like_others(spark, folder):
    """Key 0, the one with most events, becomes NULL."""
    events = feeds.random_events(16, count=90)
    for number, part in enumerate([events[:45], events[45:]]):
        rows = feeds.frame(spark, part).withColumn("k", F.nullif("k", F.lit(0)))
        rows.coalesce(1).write.parquet(f"{folder}/landing/part={number}")
        stream = stream_path(spark, f"{folder}/landing").drop("part")
        finish(append_changes(stream, f"{folder}/ledger", f"{folder}/checkpoint"))
        history.refresh_scd2(spark, f"{folder}/ledger", f"{folder}/two", ["k"], tie_break=TIES)
    versions = history.read_scd2(spark, f"{folder}/two", ["k"]).fillna(0, "k")
    assert feeds.as_scd2(versions) == feeds.expected_scd2(events)


def test_column_added_later(spark, folder):
    events = sorted(feeds.random_events(15, count=80), key=lambda e: e[3])
    first = feeds.frame(spark, events[:40])
    second = feeds.frame(spark, events[40:]).withColumn("extra", F.lit("new"))
    for number, rows in enumerate([first, second]):
        rows.coalesce(1).write.parquet(f"{folder}/landing/part={number}")
        stream = stream_path(spark, f"{folder}/landing").drop("part")
        finish(append_changes(stream, f"{folder}/ledger", f"{folder}/checkpoint"))
        history.refresh_scd2(spark, f"{folder}/ledger", f"{folder}/two", ["k"], tie_break=TIES)
    versions = history.read_scd2(spark, f"{folder}/two", ["k"])
    assert "extra" in versions.columns
    assert versions.where("extra = 'new'").count() > 0


def files_of(root):
    return {str(f.relative_to(root)): f.stat().st_size for f in Path(root).rglob("*.parquet")}


def refresh(spark, folder, kind, keys=("k",), **more):
    table, ledger = f"{folder}/{kind}", f"{folder}/ledger"
    return getattr(history, f"refresh_{kind}")(spark, ledger, table, list(keys), tie_break=TIES, **more)


def test_buckets_without_new_events_keep_their_files(spark, folder):
    events = [(key, key, "insert", 1, 0, key) for key in range(200)]
    land(spark, folder, events, 0)
    for kind in ("scd1", "scd2"):
        assert refresh(spark, folder, kind, buckets=16)
    before = {kind: files_of(f"{folder}/{kind}/latest") for kind in ("scd1", "scd2")}
    assert all(len({name.split("/")[1] for name in files}) == 16 for files in before.values())
    land(spark, folder, [(7, 70, "update", 5, 1, 900)], 1)
    for kind, files in before.items():
        assert refresh(spark, folder, kind)
        after = files_of(f"{folder}/{kind}/latest")
        assert files.items() <= after.items()
        assert {name.split("/")[0] for name in after.keys() - files.keys()} == {"_refresh=2"}
        assert len(partition_values(spark, f"{folder}/{kind}/latest/_refresh=2", "_bucket")) == 1
    seen = [*events, (7, 70, "update", 5, 1, 900)]
    assert feeds.as_scd1(history.read_scd1(spark, f"{folder}/scd1")) == feeds.expected_scd1(seen)
    assert feeds.as_scd2(history.read_scd2(spark, f"{folder}/scd2", ["k"])) == feeds.expected_scd2(seen)


def test_storage_stays_flat_over_refreshes_of_the_same_keys(spark, folder):
    """Ten refreshes: at most two states of each bucket, no open version outside of the last events."""
    seen, sizes = [], {"scd1": [], "scd2": []}
    for number in range(10):
        part = [(key, number, "update", number + 1, number, 100 * number + key) for key in range(6)]
        land(spark, folder, part, number)
        seen += part
        for kind in sizes:
            refresh(spark, folder, kind, buckets=2)
            rows = spark.read.parquet(f"{folder}/{kind}/latest").count()
            sizes[kind].append(rows)
            assert max(len(v) for v in history._Table.open(spark, f"{folder}/{kind}").versions().values()) <= 2
    assert sizes["scd1"] == sizes["scd2"] == [6] + [12] * 9
    assert not [name for name in files_of(f"{folder}/scd2/events") if "_open=1" in name]
    assert spark.read.parquet(f"{folder}/scd2/events").count() == 6 * 9
    assert feeds.as_scd2(history.read_scd2(spark, f"{folder}/scd2", ["k"])) == feeds.expected_scd2(seen)


def test_created_tables_can_be_read_before_their_first_event(spark, folder):
    columns = spark.createDataFrame([], feeds.SCHEMA).schema
    history.create_scd1(spark, f"{folder}/scd1", columns, ["k"])
    history.create_scd2(spark, f"{folder}/scd2", columns, ["k"])
    one, two = history.read_scd1(spark, f"{folder}/scd1"), history.read_scd2(spark, f"{folder}/scd2", ["k"])
    assert one.columns == columns.names and one.count() == 0
    assert two.columns == [*columns.names, "__START_AT", "__END_AT"] and two.count() == 0
    assert history.read_current(spark, f"{folder}/scd2").columns == columns.names
    events = feeds.random_events(18, count=60)
    land(spark, folder, events, 0)
    for kind in ("scd1", "scd2"):
        assert refresh(spark, folder, kind)
        # Creating a table that is there changes nothing.
        getattr(history, f"create_{kind}")(spark, f"{folder}/{kind}", columns, ["k"])
    assert feeds.as_scd1(history.read_scd1(spark, f"{folder}/scd1")) == feeds.expected_scd1(events)
    assert feeds.as_scd2(history.read_scd2(spark, f"{folder}/scd2", ["k"])) == feeds.expected_scd2(events)
    with pytest.raises(ValueError, match="neither created nor refreshed"):
        history.read_scd1(spark, f"{folder}/nothing")


def test_changed_rows_of_the_last_refresh(spark, folder):
    land(spark, folder, [(key, key, "insert", 1, 0, key) for key in range(40)], 0)
    refresh(spark, folder, "scd1", buckets=4)
    assert history.changed_rows(spark, f"{folder}/scd1", ["k"]).count() == 40
    land(spark, folder, [(3, 30, "update", 5, 1, 50), (4, 0, "delete", 5, 1, 51), (90, 9, "insert", 5, 1, 52)], 1)
    refresh(spark, folder, "scd1")
    rows = history.changed_rows(spark, f"{folder}/scd1", ["k"]).collect()
    assert sorted((r["k"], r["v"], r[IS_DELETE]) for r in rows) == [
        (3, 3, False), (3, 30, False), (4, 0, True), (4, 4, False), (90, 9, False),
    ]


def test_a_key_whose_type_widens_stays_in_its_bucket(spark, folder):
    for number, kind in enumerate(("int", "bigint")):
        rows = feeds.frame(spark, [(key, number, "insert", number + 1, number, key) for key in range(30)])
        rows = rows.withColumn("k", F.col("k").cast(kind)).coalesce(1)
        rows.write.parquet(f"{folder}/ledger/_batch_id={number}")
        refresh(spark, folder, "scd1", buckets=4)
    rows = history.read_scd1(spark, f"{folder}/scd1")
    assert dict(rows.dtypes)["k"] == "bigint" and rows.count() == 30 and rows.where("v = 1").count() == 30


def test_compacting_deals_keys_anew(spark, folder):
    events = feeds.random_events(19, count=120)
    land(spark, folder, events, 0)
    refresh(spark, folder, "scd2", buckets=2)
    history.compact_scd2(spark, f"{folder}/scd2", f"{folder}/wide", ["k"], buckets=32)
    buckets = partition_values(spark, f"{folder}/wide/latest/_refresh=1", "_bucket")
    assert len(buckets) > 2 and max(buckets) < 32
    assert feeds.as_scd2(history.read_scd2(spark, f"{folder}/wide", ["k"])) == feeds.expected_scd2(events)


@pytest.fixture
def copied(monkeypatch):
    """Rows that each refresh shuffles once more, bucket by bucket, to write them."""
    write, counts = history._Table.write_latest, []

    def counted(table, rows, keys):
        counts.append(rows.count())
        write(table, rows, keys)

    monkeypatch.setattr(history._Table, "write_latest", counted)
    return counts


def created(spark, root):
    history.create_scd2(spark, root, spark.createDataFrame([], feeds.SCHEMA).schema, ["k"])
    return root


def test_open_versions_are_written_once_into_their_buckets(spark, folder, copied):
    """Only untouched keys of the touched buckets are copied; late events and further refreshes change nothing in that."""
    table, seen = created(spark, f"{folder}/scd2"), []
    first = [(key, key, "insert", 1, 0, 100 + key) for key in range(40)]
    second = [(3, 30, "update", 5, 1, 200), (4, 0, "delete", 5, 1, 201), (5, 50, "update", 5, 1, 2), (90, 9, "insert", 5, 1, 202)]
    for number, part in enumerate((first, second)):
        land(spark, folder, part, number)
        seen += part
        refresh(spark, folder, "scd2")
        assert feeds.as_scd2(history.read_scd2(spark, table, ["k"])) == feeds.expected_scd2(seen)
        assert feeds.as_scd1(history.read_current(spark, table)) == feeds.expected_scd1(seen)
    state = history._Table.open(spark, table)
    touched = {row[0] for row in spark.createDataFrame([(k,) for k in (3, 4, 5, 90)], "k int").select(state.bucket(["k"])).collect()}
    beside = state.latest(touched).where("k not in (3, 4, 5, 90)").count()
    assert copied == [0, beside]
    assert state.latest().count() == 41
    for bucket in range(8):
        numbers = state.latest({bucket}).select(state.bucket(["k"])).distinct().collect()
        assert [row[0] for row in numbers] in ([], [bucket])


def test_an_empty_table_is_filled_without_counting_keys(spark, folder):
    """All of its keys are touched, so they are not written; hot ones among them are found all the same."""
    table = created(spark, f"{folder}/scd2")
    events = feeds.random_events(21, count=300, minutes=2000)
    land(spark, folder, events, 0)
    assert refresh(spark, folder, "scd2", hot_rows=20)
    assert not Path(f"{table}/touched").exists()
    assert feeds.as_scd2(history.read_scd2(spark, table, ["k"])) == feeds.expected_scd2(events)
    keys = sorted({event[0] for event in events})
    assert sorted(row.k for row in history.touched_keys(spark, table, ["k"]).collect()) == keys
    land(spark, folder, [(keys[0], 1, "update", 9, 1, 5000)], 1)
    assert refresh(spark, folder, "scd2")
    assert [row.k for row in history.touched_keys(spark, table, ["k"]).collect()] == keys[:1]


def test_a_fill_that_broke_off_is_made_again(spark, folder, monkeypatch):
    table = created(spark, f"{folder}/scd2")
    events = feeds.random_events(22, count=200)
    land(spark, folder, events, 0)
    move, moved = history.move_folder, []

    def breaking(spark, path, place):
        if len(moved) == 2:
            raise OSError("broke off")
        moved.append(place)
        move(spark, path, place)

    monkeypatch.setattr(history, "move_folder", breaking)
    with pytest.raises(OSError, match="broke off"):
        refresh(spark, folder, "scd2")
    assert history.read_scd2(spark, table, ["k"]).count() == 0
    monkeypatch.undo()
    assert refresh(spark, folder, "scd2")
    assert feeds.as_scd2(history.read_scd2(spark, table, ["k"])) == feeds.expected_scd2(events)


def keyless(events, every=7):
    """Events, some of them without a key."""
    return [(None if number % every == 0 else e[0], *e[1:]) for number, e in enumerate(events)]


@pytest.mark.parametrize("entry", ["kept", "lost"])
@pytest.mark.parametrize("hot_rows", [30, 1000])
def test_dealt_batches_give_the_same_tables(spark, folder, monkeypatch, entry, hot_rows):
    monkeypatch.setattr(history, "hot_keys", partial(hot_keys, hot_rows=hot_rows))
    ledger, before = f"{folder}/ledger", spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    seen = []
    for number, part in enumerate(parts_of(keyless(feeds.random_events(29, count=240, minutes=2000)), "mixed")):
        land(spark, folder, part, number, keys=["k"], buckets=3)
        seen += part
        assert is_dealt(spark, ledger, [number])
        assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before
        if entry == "lost":
            forget_batches(spark, ledger, [number])
        rows = feeds.frame(spark, seen)
        assert history.refresh_scd2(spark, ledger, f"{folder}/two", ["k"], tie_break=TIES, hot_rows=hot_rows)
        assert not is_dealt(spark, ledger, [number])
        history.create_scd1(spark, f"{folder}/one", rows.schema, ["k"])
        assert history.refresh_scd1(spark, ledger, f"{folder}/one", ["k"], tie_break=TIES)
        assert feeds.as_scd2(history.read_scd2(spark, f"{folder}/two", ["k"])) == feeds.expected_scd2(seen)
        assert feeds.as_scd1(history.read_scd1(spark, f"{folder}/one")) == feeds.expected_scd1(seen)


@pytest.mark.parametrize("hot_rows", [30, 1000])
def test_a_dealt_batch_fills_created_tables(spark, folder, monkeypatch, hot_rows):
    monkeypatch.setattr(history, "hot_keys", partial(hot_keys, hot_rows=hot_rows))
    events = keyless(feeds.random_events(31, count=240, minutes=2000))
    schema = feeds.frame(spark, events).schema
    for number, kind in enumerate(("two", "one")):
        place = f"{folder}/{kind}-place"
        land(spark, place, events, number, keys=["k"], buckets=3)
        create = history.create_scd2 if kind == "two" else history.create_scd1
        create(spark, f"{folder}/{kind}", schema, ["k"])
        assert is_dealt(spark, f"{place}/ledger", [0])
        if kind == "two":
            assert history.refresh_scd2(spark, f"{place}/ledger", f"{folder}/two", ["k"], tie_break=TIES, hot_rows=hot_rows)
        else:
            assert history.refresh_scd1(spark, f"{place}/ledger", f"{folder}/one", ["k"], tie_break=TIES)
        assert not is_dealt(spark, f"{place}/ledger", [0])
    assert feeds.as_scd2(history.read_scd2(spark, f"{folder}/two", ["k"])) == feeds.expected_scd2(events)
    assert feeds.as_scd1(history.read_scd1(spark, f"{folder}/one")) == feeds.expected_scd1(events)


def test_a_dealt_batch_is_not_shuffled(spark, folder):
    """Neither by the history of its keys nor by their last events; a batch that was not dealt is, by both."""
    def exchanges(ledger):
        new = read_batches(spark, ledger, [0])
        dealt = is_dealt(spark, ledger, [0])
        made = event_intervals(new, ["k"], tie_break=TIES, hot_rows=None, dealt=dealt), scd1_events(new, ["k"], tie_break=TIES)
        return ["Exchange" in rows._jdf.queryExecution().executedPlan().toString() for rows in made]

    events = feeds.random_events(37, count=80)
    land(spark, f"{folder}/dealt", events, 0, keys=["k"], buckets=3)
    land(spark, f"{folder}/plain", events, 0)
    assert exchanges(f"{folder}/dealt/ledger") == [False, False]
    assert exchanges(f"{folder}/plain/ledger") == [True, True]


def test_few_events_are_not_dealt(spark, folder):
    assert [buckets_for(spark, n) > 0 for n in (0, 999_999, 1_000_000)] == [False, False, True]
    assert buckets_for(spark, 10**12) == 256
    land(spark, folder, feeds.random_events(41, count=20), 0, keys=["k"], buckets=buckets_for(spark, 20))
    assert not is_dealt(spark, f"{folder}/ledger", [0])


def test_last_events_go_to_few_buckets_without_another_shuffle(spark, folder, monkeypatch):
    """The tasks that found them write them; only very many buckets are dealt out anew."""
    hints = []
    hint = type(spark.range(1)).hint
    monkeypatch.setattr(type(spark.range(1)), "hint", lambda rows, name, *more: hints.append(name) or hint(rows, name, *more))
    land(spark, folder, feeds.random_events(43, count=80), 0)
    for buckets in (8, 9):
        history.refresh_scd1(spark, f"{folder}/ledger", f"{folder}/one-{buckets}", ["k"], tie_break=TIES, buckets=buckets)
    assert hints == ["rebalance"]
    one, other = (history.read_scd1(spark, f"{folder}/one-{buckets}") for buckets in (8, 9))
    assert feeds.as_scd1(one) == feeds.as_scd1(other) != set()
