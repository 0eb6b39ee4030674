"""Schema-less JSON as ``map<string, variant>`` column expressions (FUN-1..8).

A log or change record is parsed once into a map from key to variant: unknown
keys and value types survive, a non-object text parses to null, and with
``spark.sql.variant.allowDuplicateKeys`` the last of two equal keys wins.
All helpers build JVM-side Column expressions; nothing here runs Python per row.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

OBJECT = "map<string,variant>"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_object(text: Column | str) -> Column:
    """FUN-1: JSON text -> map<string,variant>; null unless the text is an object."""
    return F.try_parse_json(_c(text)).try_cast(OBJECT)


def as_object(value: Column) -> Column:
    """A variant as map<string,variant> when it holds an object, else null."""
    return value.try_cast(OBJECT)


def is_object(value: Column) -> Column:
    """True for an object (an empty one too); false for missing, JSON null,
    array, number or text."""
    return as_object(value).isNotNull()


def present(value: Column) -> Column:
    """The key exists and does not hold JSON null."""
    return value.isNotNull() & ~F.is_variant_null(value)


def get_str(value: Column, path: str = "$") -> Column:
    """FUN-2: string at ``path``; numbers and objects come back as their text."""
    return F.try_variant_get(value, path, "string")


def get_long(value: Column, path: str = "$") -> Column:
    """FUN-2: long at ``path``; numeric text converts, other text gives null."""
    return F.try_variant_get(value, path, "bigint")


def drop_keys(obj: Column, keys: Iterable[str]) -> Column:
    """FUN-5: remove keys from a map."""
    keys = list(keys)
    return F.map_filter(obj, lambda k, v: ~k.isin(keys))


def keep_keys(obj: Column, allowed: Column) -> Column:
    """FUN-6: keep only keys contained in the array column ``allowed``."""
    return F.map_filter(obj, lambda k, v: F.array_contains(allowed, k))


def put_keys(obj: Column, values: Mapping[str, Column]) -> Column:
    """FUN-4: set keys, overwriting. Filtering first avoids map_concat's
    duplicate-key error without any session setting."""
    pairs = []
    for key, value in values.items():
        pairs += [F.lit(key), value]
    return F.map_concat(drop_keys(obj, values.keys()), F.create_map(*pairs))


def to_variant(value: Column) -> Column:
    """A map / struct / scalar column as a variant value."""
    return F.to_variant_object(value)


def to_json_text(obj: Column) -> Column:
    """FUN-7: JSON text with null-valued top-level keys left out."""
    return F.to_json(F.map_filter(obj, lambda k, v: ~F.is_variant_null(v)))


def keep_where(df, flag: str, drop_flag: bool = True):
    """Rows where the boolean column ``flag`` is true, as a 0..1 flatMap.

    A plain ``where`` on a column computed from the parsed JSON is pushed below
    the projection that computes it, and Catalyst then inlines (and repeats)
    the parse inside the filter. Filtering inside a one-element ``inline``
    keeps the parse in one place: the optimizer does not push through a
    generator.
    """
    cols = [c for c in df.columns if not (drop_flag and c == flag)]
    return rows_where(df, F.col(flag), F.struct(*[F.col(c) for c in cols]))


def rows_where(df, flag: Column, record: Column):
    """The fields of ``record`` for the rows where ``flag`` is true; a record is
    computed for those rows alone."""
    from pyspark.sql.types import ArrayType

    empty = F.array().cast(ArrayType(df.select(record.alias("r")).schema["r"].dataType))
    rows = F.when(F.coalesce(flag, F.lit(False)), F.array(record)).otherwise(empty)
    return df.select(F.inline(rows))
