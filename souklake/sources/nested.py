"""Nested records: flattening and newline clean-up, both driven by the schema, in one projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructType


def _leaves(schema: StructType, sep: str, parent: tuple[str, ...] = ()) -> list[tuple[tuple[str, ...], str]]:
    found = []
    for field in schema.fields:
        path = (*parent, field.name)
        if isinstance(field.dataType, StructType):
            found += _leaves(field.dataType, sep, path)
        else:
            found.append((path, sep.join(path)))
    return found


def _at(path: tuple[str, ...]) -> Column:
    return F.col(".".join(f"`{part.replace('`', '``')}`" for part in path))


def flatten_structs(df: DataFrame, sep: str = "_") -> DataFrame:
    """Turn every nested object into columns named ``parent<sep>child``; lists and maps stay whole."""
    leaves = _leaves(df.schema, sep)
    names = [name.lower() for _, name in leaves]
    clashes = sorted({name for name in names if names.count(name) > 1})
    if clashes:
        raise ValueError(f"flattening yields {', '.join(clashes)} more than once")
    return df.select([_at(path).alias(name) for path, name in leaves])


def _has_text(kind: DataType) -> bool:
    if isinstance(kind, StringType):
        return True
    if isinstance(kind, ArrayType):
        return _has_text(kind.elementType)
    if isinstance(kind, MapType):
        return _has_text(kind.valueType)
    return isinstance(kind, StructType) and any(_has_text(field.dataType) for field in kind.fields)


def _one_line(value: Column, kind: DataType) -> Column:
    if not _has_text(kind):
        return value
    if isinstance(kind, StringType):
        return F.replace(value, F.lit("\n"), F.lit(" "))
    if isinstance(kind, ArrayType):
        return F.transform(value, lambda item: _one_line(item, kind.elementType))
    if isinstance(kind, MapType):
        return F.transform_values(value, lambda _, item: _one_line(item, kind.valueType))
    fields = [_one_line(value.getField(field.name), field.dataType).alias(field.name) for field in kind.fields]
    # A missing object stays missing instead of becoming an object of nulls.
    return F.when(value.isNotNull(), F.struct(*fields))


def normalize_newlines(df: DataFrame) -> DataFrame:
    """Replace each newline by one blank in every text value at any depth; keys stay as they are."""
    return df.select(
        [_one_line(_at((field.name,)), field.dataType).alias(field.name) for field in df.schema.fields]
    )
