"""Splitting hot keys off, so that no task has to hold one of them whole."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A key with more rows than this is handled apart; one task sorts fewer. A table of T rows has fewer
# than T / HOT_ROWS such keys: 10^12 rows (about 100 TB) give at most 200,000.
HOT_ROWS = 5_000_000
# Counters of the sketch that finds them; the second number, the most that Spark allows, serves where the first is not
# exact enough.
SKETCH_COUNTERS = (1 << 16, 1_000_000)
# A counter may be off by this much of all rows, divided by the number of counters.
_SKETCH_ERROR = 3.5
# More hot keys than this are joined as Spark sees fit.
BROADCAST_KEYS = 100_000

ROWS_OF_KEY = "_rows_of_key"
_HASH = "_key_hash"


def hot_keys(rows: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame | None:
    """Keys with more than ``hot_rows`` rows and their numbers of rows; None where no key has so many.

    One pass over the key columns, of which every task keeps a sketch of bounded size and nothing is shuffled by key,
    names the keys that may be hot. Where there are any, they alone are counted.
    """
    hashed = rows.select(*keys, _key_hash(rows, keys).alias(_HASH))
    suspects = _suspects(hashed, hot_rows)
    if suspects is not None and suspects.isEmpty():
        return None
    few = hashed if suspects is None else hashed.join(F.broadcast(suspects), _HASH, "left_semi")
    counted = few.groupBy(*keys).agg(F.count(F.lit(1)).alias(ROWS_OF_KEY)).where(F.col(ROWS_OF_KEY) > hot_rows)
    found = counted.limit(BROADCAST_KEYS + 1).toArrow()
    if found.num_rows > BROADCAST_KEYS:
        return counted
    return F.broadcast(rows.sparkSession.createDataFrame(found, counted.schema)) if found.num_rows else None


def repeated_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame | None:
    """Keys with more than one row, to be broadcast; None where they are too many for that. Only keys are shuffled."""
    counted = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(ROWS_OF_KEY)).where(F.col(ROWS_OF_KEY) > 1)
    found = counted.limit(BROADCAST_KEYS + 1).toArrow()
    if found.num_rows > BROADCAST_KEYS:
        return None
    return F.broadcast(rows.sparkSession.createDataFrame(found, counted.schema))


def _key_hash(rows: DataFrame, keys: Sequence[str]) -> Column:
    """A hash of the key in which a NULL is not taken for the part beside it."""
    parts = []
    for key in keys:
        parts += [F.col(f"`{key}`").isNull(), F.col(f"`{key}`")]
    return F.xxhash64(*parts)


def _suspects(hashed: DataFrame, hot_rows: int) -> DataFrame | None:
    """Hashes among which those of all hot keys are; None where no sketch is exact enough to tell."""
    for counters in SKETCH_COUNTERS:
        top = F.expr(f"approx_top_k({_HASH}, {counters}, {counters})")
        # Only what may be hot comes to the driver, not every counter.
        above = F.filter(top, lambda item: item["count"] > hot_rows)["item"]
        row = hashed.agg(F.count(F.lit(1)).alias("rows"), above.alias("above")).first()
        # The sketch names what is above its error for sure, with a count that is never too low.
        if row["rows"] <= hot_rows or 2 * _SKETCH_ERROR * row["rows"] / counters <= hot_rows:
            found = [(item,) for item in row["above"] if row["rows"] > hot_rows]
            return hashed.sparkSession.createDataFrame(found, f"{_HASH} long")
    return None


def join_hot(rows: DataFrame, hot: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join a table of hot keys; NULL is a key like any other."""
    other = hot.withColumnsRenamed({key: f"_hot_{key}" for key in keys})
    same = reduce(and_, [F.col(key).eqNullSafe(F.col(f"_hot_{key}")) for key in keys])
    return rows.join(other, same, how).drop(*[f"_hot_{key}" for key in keys])


def with_group_facts(
    rows: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS, **facts: Column
) -> DataFrame:
    """Add aggregates of each row's key to the row.

    Ordinary keys take one window (one shuffle). The rows of hot keys are not shuffled at all: their
    pre-aggregated facts, one row per hot key, are broadcast. Without hot keys there is no such branch.
    """
    keys = list(keys)
    hot = hot_keys(rows, keys, hot_rows)
    window = Window.partitionBy(*keys)
    if hot is None:
        return rows.select(*rows.columns, *[value.over(window).alias(name) for name, value in facts.items()])
    ordinary = join_hot(rows, hot, keys, "left_anti").select(
        *rows.columns, *[value.over(window).alias(name) for name, value in facts.items()]
    )
    heavy = join_hot(rows, hot, keys, "left_semi")
    known = heavy.groupBy(*keys).agg(*[value.alias(name) for name, value in facts.items()])
    # One row per hot key; Spark broadcasts it by its measured size.
    return ordinary.unionByName(join_hot(heavy, known, keys, "inner").select(*rows.columns, *facts))
