"""Typed extraction from a JSON document column, driven by a field table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.numeric import wrap_uint32


def _text_schema(paths: list[str], documents: set[str]) -> T.StructType:
    """A schema of strings for the given dotted paths; sub-documents stay VARIANT."""
    tree: dict = {}
    for p in paths:
        at = tree
        *parents, leaf = p.split(".")
        for name in parents:
            at = at.setdefault(name, {})
        at[leaf] = p in documents

    def build(node: dict) -> T.StructType:
        return T.StructType(
            [T.StructField(k, build(v) if isinstance(v, dict) else T.VariantType() if v else T.StringType()) for k, v in node.items()]
        )

    return build(tree)


def epoch_real(c: Column) -> Column:
    """Fractional epoch seconds rounded (not cut) to microseconds."""
    return F.timestamp_micros(F.round(c.cast("double") * 1_000_000).cast("bigint"))


CASTS = {
    "wrapped": wrap_uint32,
    "epoch": lambda c: F.timestamp_seconds(c.cast("bigint")),
    "epoch_real": epoch_real,
    "json": lambda c: c,
}


def typed_fields(df: DataFrame, document: str, fields: list[tuple[str, str, str]], keep: list[Column]) -> DataFrame:
    """keep, then one typed column per (path, name, type).

    The document is parsed once by from_json; Catalyst prunes its schema to the
    fields a query uses. A missing parent or a JSON null gives NULL. A number,
    text or boolean that its type can't hold raises (ANSI). A malformed document
    raises too. A "json" field keeps the sub-document as VARIANT, where JSON null
    differs from a missing field.
    """
    schema = _text_schema([p for p, _, _ in fields], {p for p, _, t in fields if t == "json"})
    parsed = df.withColumn("_doc", F.from_json(F.col(document), schema, {"mode": "FAILFAST"}))

    def one(path: str, name: str, kind: str) -> Column:
        c = F.col("_doc." + path)
        return (CASTS[kind](c) if kind in CASTS else c if kind == "string" else c.cast(kind)).alias(name)

    return parsed.select(*keep, *[one(*f) for f in fields])


def variant_fields(df: DataFrame, document: str, fields: list[tuple[str, str, str]], keep: list[Column]) -> DataFrame:
    """typed_fields over a VARIANT column, as parse_json makes it.

    Each field is read by its path. A stored VARIANT is shredded into Parquet columns, and
    the paths go down into the scan, so only the fields that a query uses are read.
    """

    def one(path: str, name: str, kind: str) -> Column:
        c = F.variant_get(F.col(document), "$." + path, "variant" if kind == "json" else "string")
        return (CASTS[kind](c) if kind in CASTS else c if kind == "string" else c.cast(kind)).alias(name)

    return df.select(*keep, *[one(*f) for f in fields])


def json_text(document: Column, path: str) -> Column:
    """One field as text by path; missing or JSON null gives NULL."""
    return F.get_json_object(document, "$." + path)
