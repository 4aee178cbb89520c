"""Small constant tables as column expressions."""

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def lookup(key: Column, table: Mapping[str, object], default: object) -> Column:
    """Value of ``key`` in ``table``, else ``default``. Keys of equal value share one test."""
    keys_of: dict[object, list[str]] = {}
    for name, value in table.items():
        keys_of.setdefault(value, []).append(name)
    choice = F
    for value, names in keys_of.items():
        choice = choice.when(key.isin(names), F.lit(value))
    return choice.otherwise(F.lit(default))
