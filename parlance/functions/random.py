"""Portable, seeded randomness as pure expressions (A.10): the same value in Spark and
in any SQL engine with md5, independent of partitioning, task retries and row order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_TWO32 = 4294967296.0


def uniform(seed: int, *parts: Column | str) -> Column:
    """u in [0, 1) from the first 32 bits of md5('seed:part1:part2...')."""
    cols = [F.lit(str(seed))] + [F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts]
    h = F.substring(F.md5(F.concat_ws(":", *cols)), 1, 8)
    return F.conv(h, 16, 10).cast("double") / F.lit(_TWO32)


def beta_2_3(seed: int, key: Column, tag: str = "shift") -> Column:
    """Beta(2, 3) draw: the 2nd smallest of 4 independent uniforms (order statistic)."""
    us = F.array(*[uniform(seed, key, F.lit(f"{tag}{i}")) for i in range(4)])
    return F.element_at(F.array_sort(us), 2)


def bernoulli(seed: int, key: Column, tag: str, p: Column | float) -> Column:
    """True with probability p (LIM5)."""
    pc = p if isinstance(p, Column) else F.lit(float(p))
    return uniform(seed, key, F.lit(tag)) < pc


def sql_uniform(seed: int, *parts: str) -> str:
    """The same draw as SQL text for the DuckDB oracle (parts are SQL expressions)."""
    inner = " || ':' || ".join([f"'{seed}'"] + [f"CAST({p} AS VARCHAR)" for p in parts])
    return f"(CAST(('0x' || substr(md5({inner}), 1, 8)) AS BIGINT) / 4294967296.0)"
