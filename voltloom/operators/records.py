"""Nested records of meters as variants: paths set and read, tables of results written into them and read back.

Everything is an expression over columns: a path is set by rebuilding only the objects along it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .upsert import merge

_FIELDS = "map<string,variant>"


def fields(record: Column) -> Column:
    """The fields of an object by name; none for null and for what is no object."""
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<variant>"))
    return F.coalesce(record.try_cast(_FIELDS), empty)


def get_path(record: Column, path: Sequence[str], kind: str = "variant") -> Column:
    """The value at a path of field names, null where there is none or none of that kind."""
    for name in path[:-1]:
        record = F.try_element_at(record.try_cast(_FIELDS), F.lit(name))
    value = F.try_element_at(record.try_cast(_FIELDS), F.lit(path[-1]))
    return value if kind == "variant" else F.try_variant_get(value, "$", kind)


def set_path(record: Column, path: Sequence[str], value: Column) -> Column:
    """The record with a variant ``value`` at a path, whose objects are made where they are missing; a value in the way that is no
    object is replaced. Fields beside the path stay. A null ``value`` removes the last field."""
    if not path:
        raise ValueError("a path has one name at least")
    name, *rest = path
    own = fields(record)
    others = F.map_filter(own, lambda k, _: k != F.lit(name))
    if rest:
        return F.to_variant_object(F.map_concat(others, F.create_map(F.lit(name), set_path(F.try_element_at(own, F.lit(name)), rest, value))))
    with_value = F.map_concat(others, F.create_map(F.lit(name), value))
    return F.to_variant_object(F.when(value.isNull(), others).otherwise(with_value))


def nest(results: DataFrame, key: str, by: str, values: Sequence[str], name: str = "value") -> DataFrame:
    """One variant for each key: an object with a field for each value of ``by``, which holds the row's values. A key that has two
    rows for one value of ``by`` is an error; rows without a key or ``by`` have no place and go."""
    known = results.where(F.col(key).isNotNull() & F.col(by).isNotNull())
    entries = F.map_from_entries(F.collect_list(F.struct(F.col(by).cast("string"), F.struct(*values))))
    return known.groupBy(key).agg(F.to_variant_object(entries).alias(name))


def write_records(table: DataFrame, values: DataFrame, key: str, path: Sequence[str], record: str = "record", name: str = "value") -> DataFrame:
    """Set a path of the records of known keys; unknown ones are not added, others stay."""
    incoming = values.select(key, F.col(name).alias(record))
    return merge(table, incoming, [key], [record], insert=False, set_={record: F.when(F.col("new").isNull(), F.col(f"old.{record}")).otherwise(set_path(F.col(f"old.{record}"), path, F.col(f"new.{record}")))})


def read_records(table: DataFrame, key: str, path: Sequence[str], by: str, values: dict[str, str], record: str = "record") -> DataFrame:
    """The inverse of :func:`nest`: a row for each field of the object at a path, with its values in the given types."""
    inner = table.select(F.col(key), F.explode(fields(get_path(F.col(record), path))).alias(by, "_value"))
    return inner.select(key, by, *(get_path(F.col("_value"), [n], kind).alias(n) for n, kind in values.items()))
