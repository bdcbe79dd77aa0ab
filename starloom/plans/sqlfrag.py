"""DuckDB SQL fragments for the oracle queries (test side only).

DuckDB has no xxhash64; ``xxhash64_bigint`` / ``xxhash64_int`` spell out
Spark's XXH64 (seed 42) for an 8-byte and a 4-byte integer input with
unsigned 128-bit arithmetic modulo 2**64. NULL input gives the seed, 42,
as in Spark.
"""

from __future__ import annotations

_M = "18446744073709551616::UHUGEINT"
# The XXH64 primes and Spark's seed.
P1 = "11400714785074694791::UHUGEINT"
P2 = "14029467366897019727::UHUGEINT"
P3 = "1609587929392839161::UHUGEINT"
P4 = "9650029242287828579::UHUGEINT"
SEED = 42
P5_INT = 2870177450012600261


def _mul(a: str, p: str) -> str:
    return f"(({a}) * {p}) % {_M}"


def _rotl(h: str, r: int) -> str:
    return f"(((({h}) * {2 ** r}::UHUGEINT) % {_M}) + (({h}) // {2 ** (64 - r)}::UHUGEINT))"


def _xor(a: str, b: str) -> str:
    return f"xor(({a})::UBIGINT, ({b})::UBIGINT)::UHUGEINT"


def _let(value: str, body: str, var: str) -> str:
    return f"list_transform([{value}], lambda {var}: {body})[1]"


def _fmix(h: str) -> str:
    # h ^= h >> 33; h *= P2; h ^= h >> 29; h *= P3; h ^= h >> 32
    s1 = _let(h, _mul(_xor("a", "a // 8589934592::UHUGEINT"), P2), "a")
    s2 = _let(s1, _mul(_xor("b", "b // 536870912::UHUGEINT"), P3), "b")
    return _let(s2, _xor("c", "c // 4294967296::UHUGEINT"), "c")


def _signed(h: str) -> str:
    return _let(h, "(CASE WHEN z >= 9223372036854775808::UHUGEINT THEN z::HUGEINT - "
                   "18446744073709551616 ELSE z::HUGEINT END)::BIGINT", "z")


def xxhash64_bigint(expr: str) -> str:
    u = f"(CASE WHEN ({expr}) < 0 THEN ({expr})::HUGEINT + 18446744073709551616 ELSE ({expr})::HUGEINT END)::UHUGEINT"
    k1 = _let(_mul(u, P2), _mul(_rotl("m", 31), P1), "m")
    h0 = SEED + P5_INT + 8
    h = _xor(k1, f"{h0}::UHUGEINT")
    h = _let(h, f"(({_mul(_rotl('e', 27), P1)}) + {P4}) % {_M}", "e")
    return f"(CASE WHEN ({expr}) IS NULL THEN {SEED}::BIGINT ELSE {_signed(_fmix(h))} END)"


def xxhash64_int(expr: str) -> str:
    u = f"(CASE WHEN ({expr}) < 0 THEN ({expr})::HUGEINT + 4294967296 ELSE ({expr})::HUGEINT END)::UHUGEINT"
    h0 = SEED + P5_INT + 4
    h = _xor(f"{h0}::UHUGEINT", _mul(u, P1))
    h = _let(h, f"(({_mul(_rotl('e', 23), P2)}) + {P3}) % {_M}", "e")
    return f"(CASE WHEN ({expr}) IS NULL THEN {SEED}::BIGINT ELSE {_signed(_fmix(h))} END)"


def to_local(expr: str, tz: str = "America/Chicago") -> str:
    """Spark from_utc_timestamp(expr, tz) on a UTC wall-clock TIMESTAMP."""
    return f"timezone('{tz}', timezone('UTC', ({expr})::TIMESTAMP))"


def ts_default(expr: str, default: str = "1900-01-01 00:00:00") -> str:
    return f"coalesce(({expr})::TIMESTAMP, TIMESTAMP '{default}')"


def date_key(expr: str) -> str:
    return f"CAST(strftime(({expr}), '%Y%m%d') AS INTEGER)"
