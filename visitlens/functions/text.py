"""Text helpers and the SQL names of the row functions."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def non_empty(c: Column) -> Column:
    return c.isNotNull() & (c != "")


def labelled(ident: Column, name: Column, sep: str = ":") -> Column:
    return F.concat(ident.cast("string"), F.lit(sep), name)


def json_field(document: Column, name: str) -> Column:
    return F.get_json_object(document, f"$.{name}")


def concat_distinct(c: Column, sep: str = ",") -> Column:
    """Aggregate: distinct values, sorted, joined. NULL values are skipped.

    Meant for groups whose distinct values are few; deduplicate by a first
    ``groupBy`` where they come from very many rows.
    """
    return F.array_join(F.array_sort(F.collect_set(c)), sep)


def pair_key(a: object, b: object) -> str:
    return f"{a}_{b}"


def half_up(c: Column, scale: int) -> Column:
    """Round the decimal text of a number half up."""
    return F.round(c, scale)


def register_sql_functions(spark: SparkSession) -> None:
    """Make the row functions callable from SQL text.

    They are SQL functions, which the analyser replaces by their body, so no
    Python runs. For the distinct concatenation write
    ``listagg(DISTINCT x, ',') WITHIN GROUP (ORDER BY x)``.
    """
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION concat_long_string"
        "(id BIGINT, name STRING, sep STRING) RETURNS STRING "
        "RETURN concat(CAST(id AS STRING), sep, name)"
    )
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION get_json_value"
        "(document STRING, field STRING) RETURNS STRING "
        "RETURN get_json_object(document, concat('$.', field))"
    )
