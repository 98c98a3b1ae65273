"""Flat columns out of nested JSON text."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def field(text: Column, path: str) -> Column:
    """A dotted path as text; null where any part is missing."""
    return F.get_json_object(text, f"$.{path}")


def flat(rows: DataFrame, column: str, paths: list[str], keep: list[str] = []) -> DataFrame:
    """One column per path, named with underscores in place of the dots."""
    return rows.select(*keep, *[field(F.col(column), p).alias(p.replace(".", "_")) for p in paths])


def entities(
    rows: DataFrame, column: str, list_path: str, paths: list[str], keep: list[str] = []
) -> DataFrame:
    """One row per element of a nested list, with the wanted fields of each element."""
    elements = F.from_json(field(F.col(column), list_path), T.ArrayType(T.StringType()))
    return flat(rows.select(*keep, F.explode(elements).alias("_e")), "_e", paths, keep)
