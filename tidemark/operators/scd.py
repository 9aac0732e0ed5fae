"""Slowly changing dimensions from a stream of keyed changes.

Events of a key are put into one total order: the sequence column, then the commit version, then the
``tie_break`` columns, then row images after deletes, since a commit that rewrites a row deletes and inserts
it, and at last a hash of the business columns where no tie-break is given. Of the events that share a
sequence value only the last one counts, so versions never have zero length.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import names as N
from tidemark.functions.keys import surrogate_key
from tidemark.operators.skew import HOT_ROWS, ROWS_OF_KEY, hot_keys, join_hot, with_group_facts

# Slices of one key; a key with a third of 10^12 rows has some 80 million in each.
MOST_SLICES = 4096

DELETES = f"{N.RAW_CHANGE_TYPE} = '{N.DELETE}'"

IS_DELETE = "_is_delete"
_IMAGE = "_is_image"
_RANK = "_rank_hash"
_SLICE = "_slice"
_CUTS = "_cuts"
_EVENTS = "_events"
_MARKER = "_marker"
_NEXT = "_next"


def scd1_latest(
    changes: DataFrame,
    keys: Sequence[str],
    sequence_by: str = N.RAW_COMMIT_TIMESTAMP,
    deletes: str = DELETES,
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """Type 1: the last event of each key; a key whose last event is a delete is absent."""
    events, order = _ordered(changes, sequence_by, deletes, tie_break)
    return last_events(events, keys, order).where(~F.col(IS_DELETE)).select(*changes.columns)


def scd2_history(
    changes: DataFrame,
    keys: Sequence[str],
    sequence_by: str = N.RAW_COMMIT_TIMESTAMP,
    deletes: str = DELETES,
    tie_break: Sequence[str] = (),
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Type 2: each event but a delete opens a version, the next event of the key closes it."""
    intervals = event_intervals(changes, keys, sequence_by, deletes, tie_break, hot_rows)
    return intervals.where(~F.col(IS_DELETE)).drop(IS_DELETE)


def scd1_events(
    changes: DataFrame,
    keys: Sequence[str],
    sequence_by: str = N.RAW_COMMIT_TIMESTAMP,
    deletes: str = DELETES,
    tie_break: Sequence[str] = (),
    least: Sequence[str] = (),
) -> DataFrame:
    """The last event of each key, deletes included and flagged in ``_is_delete``.

    The columns ``least`` keep the least value any event of the key had, such as the time of its creation.
    """
    events, order = _ordered(changes, sequence_by, deletes, tie_break)
    return last_events(events, keys, order, least).select(*changes.columns, IS_DELETE)


def event_intervals(
    changes: DataFrame,
    keys: Sequence[str],
    sequence_by: str = N.RAW_COMMIT_TIMESTAMP,
    deletes: str = DELETES,
    tie_break: Sequence[str] = (),
    hot_rows: int | None = HOT_ROWS,
    dealt: bool = False,
) -> DataFrame:
    """All effective events with ``__START_AT`` and ``__END_AT``, deletes included and flagged.

    One shuffle and one sort by key serve ordinary keys. The events of a hot key are spread over slices, cut at
    quantiles of the key's own sequence; each slice learns from a marker row where the next one begins.
    ``hot_rows`` None says that no key is hot; ``dealt`` that the events of a key stand in one partition already.
    """
    keys = list(keys)
    events, order = _ordered(changes, sequence_by, deletes, tie_break)
    bounds = [F.col(sequence_by).alias(N.START_AT), F.col(_NEXT).alias(N.END_AT)]
    hot = None if hot_rows is None else hot_keys(events, keys, hot_rows)
    if hot is None:
        if not dealt:
            # Dealt out before the columns of the order are added: those are made again by whoever sorts, not shuffled.
            spread = changes.repartition(*[F.col(f"`{key}`") for key in keys])
            events, order = _ordered(spread, sequence_by, deletes, tie_break)
        stamped = _with_next(events, keys, order, sequence_by)
        return stamped.select(*changes.columns, IS_DELETE, *bounds)
    columns = [*changes.columns, IS_DELETE, _NEXT]

    ordinary = _with_next(join_hot(events, hot, keys, "left_anti"), keys, order, sequence_by)
    # Events at the same point collapse first, on the map side, so that a slice stays small even
    # where one event was copied many times.
    points = last_events(join_hot(events, hot, keys, "left_semi"), [*keys, sequence_by], order)
    slices = slice_count(hot, hot_rows)
    sliced = in_slices(points, keys, sequence_by, slices, hot_rows).withColumn(_MARKER, F.lit(False))
    in_time = Window.partitionBy(*keys).orderBy(_SLICE)
    markers = (
        sliced.groupBy(*keys, _SLICE)
        .agg(F.min(sequence_by).alias("_first"))
        .withColumn(sequence_by, F.lead("_first").over(in_time))
        .where(F.col(sequence_by).isNotNull())
        .drop("_first")
        .withColumn(_MARKER, F.lit(True))
    )
    marked = sliced.unionByName(markers, allowMissingColumns=True)
    spread = _with_next(marked, [*keys, _SLICE], [sequence_by, _MARKER], sequence_by)

    every = ordinary.select(columns).unionByName(spread.where(~F.col(_MARKER)).select(columns))
    return every.select(*changes.columns, IS_DELETE, *bounds)


def scd2_view(versions: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Type 2 versions for readers: plain validity bounds, ``is_current`` and ``is_deleted``.

    ``is_deleted`` holds for every version of a key that has no open version.
    """
    open_version = F.col(N.END_AT).isNull()
    flagged = with_group_facts(versions, keys, hot_rows, _alive=F.max(open_version))
    rest = [c for c in versions.columns if c not in (N.START_AT, N.END_AT)]
    return flagged.select(
        *rest,
        (~F.col("_alive")).alias(N.IS_DELETED),
        open_version.alias(N.IS_CURRENT),
        F.col(N.START_AT).alias(N.ROW_VALID_FROM),
        F.coalesce(F.col(N.END_AT), _moment(N.OPEN_END)).alias(N.ROW_VALID_TO),
    )


def scd2_dimension(
    versions: DataFrame,
    dim_key: str,
    business_columns: Sequence[str],
    business_key: str = N.BUSINESS_KEY,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Type 2 versions as a dimension, keyed by a hash of the business key.

    The hash is the same for all versions of a member. A member's first version starts in 1900, its
    open one ends in 9999. ``is_deleted`` marks the last version of a member that has no open one.
    """
    missing = [c for c in (N.START_AT, N.END_AT, business_key) if c not in versions.columns]
    if missing:
        raise ValueError(f"the versions lack the columns {missing}")
    start, end = F.col(N.START_AT), F.col(N.END_AT)
    wanted = versions.select(
        *dict.fromkeys([business_key, *business_columns, N.START_AT, N.END_AT])
    )
    known = with_group_facts(
        wanted,
        [business_key],
        hot_rows,
        _first_start=F.min(start),
        _last_closed=F.max(F.when(end.isNotNull(), start)),
        _alive=F.max(end.isNull()),
    )
    return known.select(
        surrogate_key(business_key).alias(dim_key),
        *dict.fromkeys([business_key, *business_columns]),
        F.when(start == F.col("_first_start"), _moment(N.FIRST_START)).otherwise(start).alias(N.ROW_VALID_FROM),
        F.coalesce(end, _moment(N.OPEN_END)).alias(N.ROW_VALID_TO),
        end.isNull().alias(N.IS_CURRENT),
        (end.isNotNull() & (start == F.col("_last_closed")) & ~F.col("_alive")).alias(N.IS_DELETED),
    )


def current_rows(versions: DataFrame) -> DataFrame:
    """The open version of each key, without the validity columns."""
    return versions.where(F.col(N.END_AT).isNull()).drop(N.START_AT, N.END_AT)


def _ordered(
    changes: DataFrame, sequence_by: str, deletes: str, tie_break: Sequence[str]
) -> tuple[DataFrame, list[str]]:
    """Flag deletes, refuse events without a sequence value, and name the columns of the order."""
    sequence = F.coalesce(
        F.col(sequence_by), F.raise_error(F.lit(f"an event has no {sequence_by}"))
    )
    is_delete = F.coalesce(F.expr(deletes), F.lit(False))
    added = {sequence_by: sequence, IS_DELETE: is_delete, _IMAGE: ~is_delete}
    last = []
    if not tie_break:
        added[_RANK] = _business_hash(changes)
        last = [_RANK]
    version = [N.RAW_COMMIT_VERSION] if N.RAW_COMMIT_VERSION in changes.columns else []
    return changes.withColumns(added), [sequence_by, *version, *tie_break, _IMAGE, *last]


def tie_of(changes: DataFrame, deletes: str = DELETES) -> Column:
    """What decides between events of one point in time where no tie-break is given.

    A table derived from ``changes`` takes it along as its tie-break, so that it keeps the events that they keep.
    """
    image = ~F.coalesce(F.expr(deletes), F.lit(False))
    return F.struct(image.alias("image"), _business_hash(changes).alias("hash"))


def _business_hash(changes: DataFrame) -> Column:
    """A hash of the columns that no run or commit stamps, so that it is the same in every run."""
    values = [
        F.array_sort(F.map_entries(field.name)) if isinstance(field.dataType, T.MapType) else F.col(field.name)
        for field in changes.schema
        if not field.name.startswith("_")
    ]
    return F.xxhash64(*values) if values else F.lit(0)


def last_events(
    events: DataFrame, keys: Sequence[str], order: Sequence[str], least: Sequence[str] = ()
) -> DataFrame:
    """The last event per key. Map tasks keep one row per key each before anything is shuffled."""
    # What only decides the order stays out of the row that is kept.
    rest = [c for c in events.columns if c not in (*keys, *least, _IMAGE, _RANK)]
    last = F.max_by(F.struct(*rest), F.struct(*order)).alias("_last")
    return events.groupBy(*keys).agg(last, *[F.min(c).alias(c) for c in least]).select(*keys, "_last.*", *least)


def _with_next(
    events: DataFrame, keys: Sequence[str], order: Sequence[str], sequence_by: str
) -> DataFrame:
    """Sequence value of the following event of the key; events overruled at their point drop out."""
    following = F.lead(sequence_by).over(Window.partitionBy(*keys).orderBy(*order))
    stamped = events.withColumn(_NEXT, following)
    return stamped.where(F.col(_NEXT).isNull() | (F.col(_NEXT) > F.col(sequence_by)))


def slice_count(hot: DataFrame, slice_rows: int) -> int:
    """A power of two that gives slices of the largest of these keys about ``slice_rows`` events or fewer."""
    largest = hot.agg(F.max(ROWS_OF_KEY)).first()[0] or 0
    slices = 2
    while slices * slice_rows < largest and slices < MOST_SLICES:
        slices *= 2
    return slices


def in_slices(
    events: DataFrame, keys: Sequence[str], sequence_by: str, slices: int, slice_rows: int | None = None
) -> DataFrame:
    """Number the slices of each key, in ``_slice``, cut at quantiles of the sequence.

    However dense the events of a key are somewhere, its slices hold about equally many. Sequences without quantiles, like
    texts, are cut at every value. Events of one key differ in their sequence here. With ``slice_rows`` a key gets no more
    slices than it needs for so many events in each, so all cuts together are few, however many keys there are.
    """
    kind = events.schema[sequence_by].dataType
    if not isinstance(kind, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        return events.withColumn(_SLICE, F.col(sequence_by))
    shares = [number / slices for number in range(1, slices)]
    quantiles = F.percentile_approx(sequence_by, shares, max(10_000, 4 * slices)).alias(_CUTS)
    if slice_rows is None:
        cuts = events.groupBy(*keys).agg(quantiles)
    else:
        known = events.groupBy(*keys).agg(quantiles, F.count(F.lit(1)).alias(_EVENTS))
        needed = F.pow(F.lit(2), F.ceil(F.log2(F.greatest(F.col(_EVENTS) / slice_rows, F.lit(2.0))))).cast("int")
        every = (F.lit(slices) / F.least(needed, F.lit(slices))).cast("int")
        cuts = known.withColumn(_CUTS, F.filter(_CUTS, lambda _, place: (place + 1) % every == 0)).drop(_EVENTS)
    # Binary search for the number of cuts up to the event; steps past the last cut of a key are not taken.
    steps = [slices >> n for n in range(1, slices.bit_length())]
    before = F.reduce(
        F.array(*[F.lit(step) for step in steps]),
        F.lit(0),
        lambda low, step: F.when(F.get(_CUTS, low + step - 1) <= F.col(sequence_by), low + step).otherwise(low),
    )
    return join_hot(events, cuts, keys, "inner").withColumn(_SLICE, before).drop(_CUTS)


def _moment(text: str) -> Column:
    return F.lit(text).cast("timestamp")
