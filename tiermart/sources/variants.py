"""JSON text whose records drift: one schema over all of them, and a column per observed type.

Records are parsed once to variants. Their schemas merge in one distributed aggregate, in which a
field that comes, goes or changes its type is no conflict: what is never seen is missing, and a field
of several types stays a variant, which ``split_variants`` turns into one column per type.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RECORD = "_record"


def parsed(rows: DataFrame, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Rows with their record as a variant in ``_record``, and the rows whose text is no JSON.

    A NULL text is a record without fields, not an unreadable one.
    """
    both = rows.withColumn(RECORD, F.try_parse_json(text_col))
    bad = F.col(RECORD).isNull() & F.col(text_col).isNotNull()
    return both.where(~bad), both.where(bad).drop(RECORD)


def merged_schema(records: DataFrame, column: str = RECORD) -> T.DataType:
    """The type that all records of a variant column fit; one small value comes to the driver."""
    found = records.agg(F.schema_of_variant_agg(column)).first()[0]
    return T.DataType.fromDDL(_as_ddl(found)) if found else T.NullType()


def _as_ddl(schema: str) -> str:
    """A variant's schema text as a type; fields that were only ever null are text."""
    return re.sub(r"\bOBJECT<", "STRUCT<", re.sub(r"\bVOID\b", "STRING", schema))


def flat_records(records: DataFrame, schema: T.DataType | None = None) -> DataFrame:
    """One typed column per field of the records, beside the columns that were there.

    ``schema`` is that of ``merged_schema`` unless given, so that later loads may keep an earlier one; values that
    do not fit are NULL.
    """
    kind = merged_schema(records) if schema is None else schema
    if not isinstance(kind, T.StructType):
        raise ValueError(f"records are objects, not {kind.simpleString()}")
    typed = F.try_variant_get(RECORD, "$", kind.simpleString()).alias("_fields")
    return records.select(*(c for c in records.columns if c != RECORD), typed).select(
        *(c for c in records.columns if c != RECORD), "_fields.*"
    )


def _variants(kind: T.DataType, path: tuple[str, ...] = ()) -> Iterator[tuple[str, ...]]:
    """Paths of the variants in a type, through structs at any depth."""
    if isinstance(kind, T.VariantType):
        yield path
    elif isinstance(kind, T.StructType):
        for f in kind.fields:
            yield from _variants(f.dataType, (*path, f.name))


def _at(path: tuple[str, ...]) -> Column:
    return F.col(".".join(f"`{name}`" for name in path))


def split_variants(df: DataFrame) -> DataFrame:
    """Every variant, in structs too, as one column per type it was seen with.

    Columns are called after the path and the type, such as ``props_size_bigint``; a value stands in the column of its own type
    only. Objects whose fields hold variants are split further, arrays of variants stay JSON text. The types are
    found in the data, in one aggregate for all columns of a round.
    """
    while paths := list(_variants(df.schema)):
        kinds = df.agg(*(F.collect_set(F.schema_of_variant(_at(p))).alias(f"_{i}") for i, p in enumerate(paths))).first()
        splits: dict[tuple[str, ...], list[Column]] = {}
        for path, seen in zip(paths, kinds, strict=True):
            name = "_".join(path)
            splits[path] = [_of_type(path, kind).alias(f"{name}_{suffix}") for suffix, kind in _distinct(seen)]
        df = _replaced(df, splits)
    return df


def _distinct(seen: list[str]) -> list[tuple[str, list[str]]]:
    """Suffix and schemas of each kind of value: scalars by type, all objects together, all arrays together."""
    found: dict[str, list[str]] = {}
    for schema in sorted(seen):
        if schema == "VOID":
            continue
        head = re.match(r"[A-Z]+", schema)[0]
        suffix = {"OBJECT": "object", "ARRAY": "array"}.get(head, re.sub(r"\W+", "_", schema.lower()).strip("_"))
        suffix = "decimal" if head == "DECIMAL" else suffix
        found.setdefault(suffix, []).append(schema)
    return sorted(found.items())


def _of_type(path: tuple[str, ...], schemas: list[str]) -> Column:
    value, own = _at(path), F.schema_of_variant(_at(path)).isin(schemas)
    if schemas[0].startswith("ARRAY"):
        return F.when(own, F.to_json(value))
    if schemas[0].startswith("OBJECT"):
        fields = sorted({name for s in schemas for name in T.DataType.fromDDL(_as_ddl(s)).fieldNames()})
        kind = "struct<" + ", ".join(f"`{name}`: variant" for name in fields) + ">"
        return F.try_variant_get(F.when(own, value), "$", kind)
    kind = "decimal(38,18)" if schemas[0].startswith("DECIMAL") else schemas[0].lower()
    return F.try_variant_get(F.when(own, value), "$", kind)


def _replaced(df: DataFrame, splits: dict[tuple[str, ...], list[Column]]) -> DataFrame:
    """``df`` with its variants' columns in place of the variants; structs that held one are opened."""
    opened = {path[0] for path in splits}

    def columns(kind: T.DataType, path: tuple[str, ...]) -> Iterator[Column]:
        if path in splits:
            yield from splits[path]
        elif isinstance(kind, T.StructType) and any(p[: len(path)] == path for p in splits):
            for f in kind.fields:
                yield from columns(f.dataType, (*path, f.name))
        else:
            yield _at(path).alias("_".join(path))

    out: list[Column] = []
    for f in df.schema.fields:
        out += columns(f.dataType, (f.name,)) if f.name in opened else [F.col(f"`{f.name}`")]
    return df.select(*out)
