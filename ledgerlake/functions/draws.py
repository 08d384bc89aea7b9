"""Counter-based random draws: a pure function of (seed, row index, column).

``rand(seed)`` depends on how rows fall into partitions and is not stable when
a lost task is recomputed, so it cannot be used. Instead every draw is a
32-bit integer hash of the row index, mixed in 64-bit integer arithmetic that
Spark and DuckDB evaluate identically:

    mix1(x)     = ((x XOR (x >> 16)) * 73244475) AND 0xFFFFFFFF
    mix(x)      = z XOR (z >> 16)  with  z = mix1(mix1(x))
    base(i)     = mix((lo(i) + seed * 1000003 + mix(hi(i))) AND 0xFFFFFFFF)
    H(i, c)     = mix((base(i) + c * 2654435761) AND 0xFFFFFFFF)
    pick(i,c,k) = (H(i, c) * k) >> 32                     -- uniform in 0..k-1

All products stay below 2**59, so ANSI overflow checks never fire. Each mixing
step is its own projection: the step mentions its input twice, and staging it
keeps the expression tree linear (Catalyst will not collapse projections that
would duplicate a non-trivial expression). The whole chain still runs inside a
single whole-stage-codegen span with no shuffle.

``lo``/``hi`` are the low and high 32-bit words of the index; ``mix(0) = 0``,
so the high word only matters past 2**32 rows, where it keeps rows ``i`` and
``i + 2**32`` unrelated. The mixed state is 32 bits: a hash for test data, not
cryptography.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MASK32 = 0xFFFFFFFF
MIX_MULT = 73244475
SEED_MULT = 1000003
COLUMN_MULT = 2654435761

# Column ids of the draws (fixed: changing them changes every generated row).
C_DATE, C_PRODUCT, C_TYPE, C_AMOUNT, C_AGENCY, C_COUNTRY = 1, 2, 3, 4, 5, 6
C_SPOIL, C_LANDING, C_SAMPLE, C_PLANT = 7, 8, 9, 10
MOVEMENT_DRAWS = (C_DATE, C_PRODUCT, C_TYPE, C_AMOUNT, C_AGENCY, C_COUNTRY)


def _mask(c: Column) -> Column:
    return c.bitwiseAND(F.lit(MASK32))


def _xorshift(c: Column) -> Column:
    return c.bitwiseXOR(F.shiftright(c, 16))


def _mix1(c: Column) -> Column:
    return _mask(_xorshift(c) * F.lit(MIX_MULT))


def _restage(df: DataFrame, names: Iterable[str], fn) -> DataFrame:
    names = list(names)
    return df.select(*[c for c in df.columns if c not in names], *[fn(F.col(n)).alias(n) for n in names])


def with_hashes(df: DataFrame, index_col: str, seed: int, draws: Iterable[int]) -> DataFrame:
    """Append ``h<c>`` (BIGINT in 0..2**32-1) for each draw column id ``c``."""
    draws = sorted(set(draws))
    hx, hh = "__hx", "__hh"
    # High word of the index, mixed (mix(0) = 0, so indices below 2**32 are
    # unaffected): rows i and i + 2**32 get unrelated draws.
    out = df.withColumn(hh, F.shiftright(F.col(index_col).cast("bigint"), 32))
    out = _restage(out, [hh], _mix1)
    out = _restage(out, [hh], _mix1)
    out = _restage(out, [hh], _xorshift)
    out = out.withColumn(hx, _mask(F.col(index_col).cast("bigint").bitwiseAND(F.lit(MASK32))
                                   + F.lit(seed * SEED_MULT) + F.col(hh))).drop(hh)
    out = _restage(out, [hx], _mix1)
    out = _restage(out, [hx], _mix1)
    out = _restage(out, [hx], _xorshift)
    hs = [f"h{c}" for c in draws]
    out = out.select(
        *[c for c in out.columns if c != hx],
        *[_mask(F.col(hx) + F.lit(c * COLUMN_MULT)).alias(f"h{c}") for c in draws],
    )
    out = _restage(out, hs, _mix1)
    out = _restage(out, hs, _mix1)
    out = _restage(out, hs, _xorshift)
    # Optimizer barrier: a filter on a hash-derived column would otherwise be
    # pushed below these projections with every alias substituted, re-inlining
    # the whole chain (exponential in the number of steps). Predicates cannot
    # cross a generator on the columns it produces; a one-element ``inline``
    # costs one struct per row and keeps the chain in a single codegen stage.
    return out.select(F.inline(F.array(F.struct(*[F.col(c) for c in out.columns]))))


def pick(h: Column | str, k: int | Column) -> Column:
    """Uniform integer in 0..k-1 from a 32-bit hash column."""
    h = F.col(h) if isinstance(h, str) else h
    k = F.lit(k) if isinstance(k, int) else k
    return F.shiftright(h * k.cast("bigint"), 32)


def below(h: Column | str, fraction: float) -> Column:
    """True for a deterministic ``fraction`` of rows (hash threshold)."""
    h = F.col(h) if isinstance(h, str) else h
    return h < F.lit(int(fraction * (MASK32 + 1)))


# --- The same kernel as DuckDB SQL text (used by the oracle statements) -----

def sql_hash_ctes(prefix: str, source: str, index_col: str, seed: int, draws: Iterable[int]) -> list[str]:
    """CTE definitions appending h<c> columns to ``source``; last CTE is ``{prefix}_h``.

    One mixing step per CTE, as in the Spark plan, so no expression nests.
    """
    draws = sorted(set(draws))
    m = MASK32

    def mix1(x: str) -> str:
        return f"((xor({x}, {x} >> 16) * {MIX_MULT}) & {m})"

    def xs(x: str) -> str:
        return f"xor({x}, {x} >> 16)"

    hs = [f"h{c}" for c in draws]
    ctes = [
        f"{prefix}_wa AS (SELECT *, CAST({index_col} AS BIGINT) >> 32 AS __hh FROM {source})",
        f"{prefix}_wb AS (SELECT * REPLACE ({mix1('__hh')} AS __hh) FROM {prefix}_wa)",
        f"{prefix}_wc AS (SELECT * REPLACE ({mix1('__hh')} AS __hh) FROM {prefix}_wb)",
        f"{prefix}_wd AS (SELECT * REPLACE ({xs('__hh')} AS __hh) FROM {prefix}_wc)",
        f"{prefix}_0 AS (SELECT * EXCLUDE (__hh), ((CAST({index_col} AS BIGINT) & {m}) + {seed * SEED_MULT} + __hh) & {m} AS __hx "
        f"FROM {prefix}_wd)",
        f"{prefix}_1 AS (SELECT * REPLACE ({mix1('__hx')} AS __hx) FROM {prefix}_0)",
        f"{prefix}_2 AS (SELECT * REPLACE ({mix1('__hx')} AS __hx) FROM {prefix}_1)",
        f"{prefix}_3 AS (SELECT * REPLACE ({xs('__hx')} AS __hx) FROM {prefix}_2)",
        f"{prefix}_4 AS (SELECT * EXCLUDE (__hx), "
        + ", ".join(f"(__hx + {c * COLUMN_MULT}) & {m} AS h{c}" for c in draws)
        + f" FROM {prefix}_3)",
        f"{prefix}_5 AS (SELECT * REPLACE ({', '.join(mix1(h) + ' AS ' + h for h in hs)}) FROM {prefix}_4)",
        f"{prefix}_6 AS (SELECT * REPLACE ({', '.join(mix1(h) + ' AS ' + h for h in hs)}) FROM {prefix}_5)",
        f"{prefix}_h AS (SELECT * REPLACE ({', '.join(xs(h) + ' AS ' + h for h in hs)}) FROM {prefix}_6)",
    ]
    return ctes


def sql_pick(h: str, k: int | str) -> str:
    return f"(({h} * {k}) >> 32)"


def sql_below(h: str, fraction: float) -> str:
    return f"({h} < {int(fraction * (MASK32 + 1))})"
