"""Landed JSON by way of VARIANT: each field read by path, with what it was.

``parse`` gives the documents that ``extract.parse`` gives (and every ``extract_*`` takes), built field by field with
``try_variant_get``. A field is *absent* (no such key), *null* (an explicit JSON null), *mistyped* (there, but not
readable as its type) or *given*; only VARIANT tells the four apart. A count that is absent reads 0, by that test and
not by a list of the document's keys; a mistyped field reads NULL and is counted, where a schema-driven parse drops it
silently. A line that is no JSON at all is a NULL document and counted as unreadable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

from teampulse import schemas

STATES = ("absent", "null", "mistyped", "given")


def documents(landed: DataFrame, repo: str | None = None) -> DataFrame:
    """(repo, order, value, v): each line with its VARIANT, NULL if it is no JSON. Parsed once, below a generator."""
    repo_col = F.lit(repo) if repo is not None else F.col("repo")
    order = [F.col("_seq")] if "_seq" in landed.columns else []
    return landed.select(repo_col.alias("repo"), *order, "value", F.explode(F.array(F.try_parse_json("value"))).alias("v"))


def _type(kind: DataType) -> str:
    """The type to ask a VARIANT for: values of maps are kept as they are."""
    return "map<string,variant>" if isinstance(kind, MapType) else kind.simpleString()


def _leaves(schema: StructType, path: str = "$"):
    """(path, type) of the fields that are no objects; a list is one field."""
    for f in schema.fields:
        at = f"{path}.{f.name}"
        if isinstance(f.dataType, StructType):
            yield from _leaves(f.dataType, at)
        else:
            yield at, f.dataType


def state(v: Column, path: str, kind: DataType) -> Column:
    """One of STATES for the field at ``path``; a field below a missing or null object is absent."""
    there = F.try_variant_get(v, path, "variant")
    return (F.when(there.isNull(), "absent").when(F.is_variant_null(there), "null")
            .when(F.try_variant_get(v, path, _type(kind)).isNull(), "mistyped").otherwise("given"))


def _value(v: Column, schema: StructType, zero: tuple[str, ...], path: str = "$") -> Column:
    out = []
    for f in schema.fields:
        at = f"{path}.{f.name}"
        there = F.try_variant_get(v, at, "variant")
        if isinstance(f.dataType, StructType):
            gone = there.isNull() | F.is_variant_null(there)
            value = F.when(~gone, _value(v, f.dataType, zero, at))
        elif isinstance(f.dataType, MapType):
            value = F.transform_values(F.try_variant_get(v, at, _type(f.dataType)), lambda _, x: x.cast("string"))
        else:
            value = F.try_variant_get(v, at, _type(f.dataType))
            if path == "$" and f.name in zero:
                value = F.when(there.isNull(), F.lit(0)).otherwise(value)
        out.append(value.cast(f.dataType).alias(f.name))
    return F.struct(*out)


def parse(landed: DataFrame, kind: str, repo: str | None = None) -> DataFrame:
    """(repo, order, d): the documents in the form of ``schemas.PAYLOADS[kind]``; take it to any ``extract_*``."""
    docs = documents(landed, repo)
    order = [c for c in docs.columns if c == "_seq"]
    return docs.where(F.col("v").isNotNull()).select(
        "repo", *order, _value(F.col("v"), schemas.PAYLOADS[kind], schemas.ABSENT_IS_ZERO.get(kind, ())).alias("d"))


def field_states(landed: DataFrame, kind: str, repo: str | None = None) -> DataFrame:
    """One row per field of a payload: kind, field, and in how many documents it was absent, null, mistyped or given.
    One reading; the counts are one aggregate."""
    leaves = list(_leaves(schemas.PAYLOADS[kind]))
    docs = documents(landed, repo).where(F.col("v").isNotNull())
    counts = docs.agg(*[F.count_if(state(F.col("v"), path, type_) == s).alias(f"{i}_{s}")
                        for i, (path, type_) in enumerate(leaves) for s in STATES])
    rows = F.array(*[F.struct(F.lit(path[2:]).alias("field"), *[F.col(f"{i}_{s}").alias(f"{s}s" if s == "null" else s) for s in STATES])
                     for i, (path, _) in enumerate(leaves)])
    return counts.select(F.lit(kind).alias("kind"), F.explode(rows).alias("r")).select("kind", "r.*")


def mistyped(landed: DataFrame, kind: str, repo: str | None = None) -> DataFrame:
    """One row: documents, those that are no JSON, and those with a mistyped field."""
    v = F.col("v")
    bad = F.lit(False)
    for path, type_ in _leaves(schemas.PAYLOADS[kind]):
        bad = bad | (state(v, path, type_) == "mistyped")
    return documents(landed, repo).agg(F.lit(kind).alias("kind"), F.count(F.lit(1)).alias("documents"),
                                       F.count_if(v.isNull()).alias("unreadable"),
                                       F.count_if(v.isNotNull() & bad).alias("mistyped"))
