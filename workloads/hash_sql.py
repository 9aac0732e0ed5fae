"""64-bit xxHash (seed 42) as plain SQL, for checking surrogate keys outside Spark.

Written from the published algorithm. 64-bit words are kept in UHUGEINT; each SELECT does one step.
"""

from __future__ import annotations

# The primes of the algorithm, Spark's seed, and the word size.
P1 = "11400714785074694791::UHUGEINT"
P2 = "14029467366897019727::UHUGEINT"
P3 = "1609587929392839161::UHUGEINT"
P4 = "9650029242287828579::UHUGEINT"
P5 = "2870177450012600261::UHUGEINT"
SEED = "42::UHUGEINT"
WORD = "18446744073709551616::UHUGEINT"
LONGEST = 31


def hash_int(source: str, value: str, name: str) -> str:
    """``source`` (a SELECT) plus ``name``: the hash of the INTEGER column ``value``; NULL gives the seed."""
    unsigned = f"(CASE WHEN {value} < 0 THEN {value}::HUGEINT + 4294967296 ELSE {value}::HUGEINT END)::UHUGEINT"
    sql = f"SELECT *, ({SEED} + {P5} + 4::UHUGEINT) % {WORD} AS _h FROM ({source})"
    sql = _set(sql, "_h", f"xor(_h, {_times(unsigned, P1)})")
    sql = _set(sql, "_h", f"({_times(_rotated('_h', 23), P2)} + {P3}) % {WORD}")
    return _finish(sql, name, f"{value} IS NULL")


def hash_text(source: str, value: str, name: str) -> str:
    """``source`` plus ``name``: the hash of the ASCII column ``value`` of at most 31 characters."""
    sql = (
        f"SELECT *, length({value}) AS _n, ({SEED} + {P5} + length({value})::UHUGEINT) % {WORD} AS _h, "
        f"0::UHUGEINT AS _w, 8 * (length({value}) // 8) AS _p FROM ({source})"
    )
    for word in range(LONGEST // 8):
        there = f"_n >= {8 * (word + 1)}"
        sql = _set(sql, "_w", _bytes(value, str(8 * word), 8))
        sql = _set(sql, "_w", _times("_w", P2))
        sql = _set(sql, "_w", _times(_rotated("_w", 31), P1))
        sql = _set(sql, "_h", _if(there, "xor(_h, _w)"))
        sql = _set(sql, "_h", _if(there, f"({_times(_rotated('_h', 27), P1)} + {P4}) % {WORD}"))
    half = "_n - 8 * (_n // 8) >= 4"
    sql = _set(sql, "_h", _if(half, f"xor(_h, {_times(_bytes(value, '_p', 4), P1)})"))
    sql = _set(sql, "_h", _if(half, f"({_times(_rotated('_h', 23), P2)} + {P3}) % {WORD}"))
    sql = _set(sql, "_p", f"CASE WHEN {half} THEN _p + 4 ELSE _p END")
    for byte in range(3):
        there = f"_p + {byte} < _n"
        sql = _set(sql, "_h", _if(there, f"xor(_h, {_times(_bytes(value, f'_p + {byte}', 1), P5)})"))
        sql = _set(sql, "_h", _if(there, _times(_rotated("_h", 11), P1)))
    sql = f"SELECT * EXCLUDE (_n, _w, _p) FROM ({sql})"
    return _finish(sql, name, f"{value} IS NULL")


def _finish(sql: str, name: str, is_null: str) -> str:
    sql = _set(sql, "_h", f"xor(_h, _h // {1 << 33}::UHUGEINT)")
    sql = _set(sql, "_h", _times("_h", P2))
    sql = _set(sql, "_h", f"xor(_h, _h // {1 << 29}::UHUGEINT)")
    sql = _set(sql, "_h", _times("_h", P3))
    sql = _set(sql, "_h", f"xor(_h, _h // {1 << 32}::UHUGEINT)")
    signed = f"CASE WHEN _h >= {1 << 63}::UHUGEINT THEN _h::HUGEINT - {1 << 64}::HUGEINT ELSE _h::HUGEINT END"
    return (
        f"SELECT * EXCLUDE (_h), (CASE WHEN {is_null} THEN 42 ELSE {signed} END)::BIGINT AS {name} FROM ({sql})"
    )


def _set(sql: str, column: str, value: str) -> str:
    return f"SELECT * REPLACE ({value} AS {column}) FROM ({sql})"


def _if(condition: str, value: str) -> str:
    return f"CASE WHEN {condition} THEN {value} ELSE _h END"


def _times(left: str, right: str) -> str:
    return f"(({left}) * {right}) % {WORD}"


def _rotated(value: str, bits: int) -> str:
    return f"(({value} * {1 << bits}::UHUGEINT) % {WORD} + {value} // {1 << (64 - bits)}::UHUGEINT)"


def _bytes(value: str, offset: str, count: int) -> str:
    """``count`` characters from ``offset`` on as a little-endian number."""
    return " + ".join(
        f"ascii(substr({value}, ({offset}) + {i + 1}, 1))::UHUGEINT * {256**i}::UHUGEINT"
        for i in range(count)
    )
