"""What the registered queries share: reading the tables, and SQL pieces."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokens_sql(text: str) -> str:
    return f"list_filter(string_split_regex(lower({text}), '\\s+'), lambda w: w <> '')"


def words_sql(text: str) -> str:
    return f"list_filter(string_split_regex({text}, '\\s+'), lambda w: w <> '')"


def sentences_sql(text: str) -> str:
    """Sentences; the gap is marked first because the SQL engine's regex has no look-behind."""
    marked = f"regexp_replace({text}, '([.!?])\\s+', '\\1' || chr(1), 'g')"
    return f"list_filter(string_split({marked}, chr(1)), lambda s: regexp_matches(s, '\\S'))"


def place_sql(token: str, dim: int = 64) -> str:
    """The hashed place of a token."""
    return f"(CAST(('0x' || substr(md5({token}), 1, 4)) AS INTEGER) % {dim})"


def counts_sql(name: str, source: str, key: str, text: str, dim: int = 64) -> str:
    """A CTE ``name(key, p, c)`` of hashed token counts and ``name_norm(key, n)``."""
    return f"""
{name} AS (
  SELECT {key}, {place_sql('w', dim)} AS p, count(*)::DOUBLE AS c
  FROM (SELECT {key}, unnest({tokens_sql(text)}) AS w FROM {source}) GROUP BY ALL),
{name}_norm AS (SELECT {key}, sqrt(sum(c * c)) AS n FROM {name} GROUP BY ALL)"""
