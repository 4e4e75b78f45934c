"""Registered queries (one per operator family of SURVEY §2) and their DuckDB oracles.

Each query is ``fn(spark, sf_dir) -> DataFrame`` over the whole test tables. Its oracle
is an independent SQL text over the same tables; where SQL cannot do the work on whole
texts in reasonable time the oracle is omitted and a test checks the query against a
brute-force computation instead.

Conventions: every computed column is aliased identically in both forms, integers are
BIGINT, floating outputs are rounded to 6 decimals.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


# ---- SQL building blocks shared by oracles ---------------------------------------------

# whitespace split of trimmed text, [] for empty text
SQL_WORDS = """(CASE WHEN regexp_replace({t}, '^\\s+|\\s+$', '', 'g') = '' THEN []::VARCHAR[]
  ELSE string_split_regex(regexp_replace({t}, '^\\s+|\\s+$', '', 'g'), '\\s+') END)"""

SQL_DEGRADE = """array_to_string(flatten(list_transform(range(len({w})), lambda i:
  CASE WHEN i % 7 = 3 THEN []::VARCHAR[]
       WHEN i % 13 = 6 THEN [CASE WHEN i % 11 = 5 THEN reverse({w}[i + 1]) ELSE {w}[i + 1] END,
                             CASE WHEN i % 11 = 5 THEN reverse({w}[i + 1]) ELSE {w}[i + 1] END]
       ELSE [CASE WHEN i % 11 = 5 THEN reverse({w}[i + 1]) ELSE {w}[i + 1] END] END)), ' ')"""

SQL_BASIC_NORM = """regexp_replace(lower(regexp_replace(nfc_normalize(
  regexp_replace(regexp_replace(lower({t}), '[<\\[][^>\\]]*[>\\]]', '', 'g'), '\\(([^)]+?)\\)', '', 'g')),
  '[\\p{{M}}\\p{{S}}\\p{{P}}]', ' ', 'g')), '\\s+', ' ', 'g')"""

SQL_HEBREW_PRE = """replace(replace(regexp_replace(regexp_replace({t},
  '[\\x{{061C}}\\x{{200B}}-\\x{{200F}}\\x{{202A}}-\\x{{202E}}\\x{{2066}}-\\x{{2069}}\\x{{FEFF}}]', '', 'g'),
  '[\\x{{05B0}}-\\x{{05BC}}\\x{{05C1}}\\x{{05C2}}\\x{{05C7}}]', '', 'g'), '"', ''), '''', '')"""


def sql_hebrew_norm(t: str) -> str:
    return SQL_BASIC_NORM.format(t=SQL_HEBREW_PRE.format(t=t))


def sql_words(t: str) -> str:
    return SQL_WORDS.format(t=t)


def sql_degrade(words_expr: str) -> str:
    return SQL_DEGRADE.format(w=words_expr)


# importing the query modules fills the registry
from parlance.plans import (  # noqa: E402,F401
    queries_build, queries_eval, queries_labels, queries_rows, queries_sampling, queries_stream, queries_vectors)
