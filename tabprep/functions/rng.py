"""Portable, seeded randomness.

``rand()`` depends on partitioning and cannot be reproduced by another
engine. Draws here are a pure function of (seed, key, purpose):

    h = int(first 15 hex digits of md5("seed:key:purpose"), 16)   # 60 bits
    u = (h // 2**7) / 2**53                                       # in [0, 1)

so the same draw comes out of Spark, DuckDB or pandas, and re-running a task
after executor loss yields identical rows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_53 = 9007199254740992.0


def _key_text(*parts) -> Column:
    cols = []
    for i, p in enumerate(parts):
        if i:
            cols.append(F.lit(":"))
        cols.append(p.cast("string") if isinstance(p, Column) else F.lit(str(p)))
    return F.concat(*cols)


def hash_int(seed, key: Column, purpose: str, *more: Column) -> Column:
    """Unsigned 60-bit integer drawn from md5 (bigint column)."""
    text = _key_text(seed, key, purpose, *more)
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def uniform(seed, key: Column, purpose: str, *more: Column) -> Column:
    """u in [0, 1) (double column)."""
    return F.shiftright(hash_int(seed, key, purpose, *more), 7) / F.lit(TWO_53)


def sql_uniform(seed, key_sql: str, purpose: str, *more_sql: str) -> str:
    """DuckDB text of the same draw; ``key_sql`` is any SQL expression."""
    parts = [f"'{seed}'", "':'", f"CAST({key_sql} AS VARCHAR)", "':'", f"'{purpose}'"]
    for m in more_sql:
        parts += ["':'", f"CAST({m} AS VARCHAR)"]
    text = " || ".join(parts)
    return f"((CAST(('0x' || substr(md5({text}), 1, 15)) AS BIGINT) >> 7) / 9007199254740992.0)"


def sql_hash_int(seed, key_sql: str, purpose: str, *more_sql: str) -> str:
    parts = [f"'{seed}'", "':'", f"CAST({key_sql} AS VARCHAR)", "':'", f"'{purpose}'"]
    for m in more_sql:
        parts += ["':'", f"CAST({m} AS VARCHAR)"]
    text = " || ".join(parts)
    return f"CAST(('0x' || substr(md5({text}), 1, 15)) AS BIGINT)"
