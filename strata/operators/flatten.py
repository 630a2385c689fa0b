"""Explode a feed's record list and flatten records into typed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, StringType, StructType

from strata.functions.records import en_name
from strata.functions.typed import parse
from strata.spec import FeedSpec, Field

NODE = "_node"
META = "_meta"


def _record_list(df: DataFrame, spec: FeedSpec) -> Column:
    """The record list as ``array<struct>`` whatever form bronze stored it in:
    raw JSON text (object or array), a struct (lone record) or an array."""
    dtype = df.select(F.col(spec.array_path)).schema.fields[0].dataType
    c = F.col(spec.array_path)
    if isinstance(dtype, StringType):
        return F.from_json(c, ArrayType(spec.node_schema))
    if isinstance(dtype, StructType):
        return F.when(c.isNotNull(), F.array(c))
    if isinstance(dtype, ArrayType):
        return c
    raise TypeError(f"{spec.array_path} has unsupported type {dtype.simpleString()}")


def explode_records(df: DataFrame, spec: FeedSpec, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per record; a document with an empty, NULL or unparsable list
    gives one row with a NULL record (``explode_outer``, SURVEY G9)."""
    unknown = [F.col("unknown")] if any(f.path.startswith("?") for f in spec.fields) else []
    return df.select(
        F.col("ingestion_metadata").alias(META), *unknown,
        *[F.col(k) for k in keep],
        F.explode_outer(_record_list(df, spec)).alias(NODE),
    )


def field_column(f: Field) -> Column:
    if f.path.startswith("@"):
        source = F.col(f"{META}.{f.path[1:]}")
    elif f.path.startswith("?"):
        place, _, name = f.path[1:].partition(".")
        # Raw JSON text of a string keeps its quotes; everything else is read as it stands.
        raw = F.col(f"unknown.{place}")[name]
        source = F.when(raw.startswith('"'), F.get_json_object(F.concat(F.lit('{"v":'), raw, F.lit("}")), "$.v")).otherwise(raw)
    elif f.kind == "name":
        source = en_name(NODE, f.path)
    else:
        source = F.col(f"{NODE}.{f.path}")
    return parse(f.kind, source).alias(f.name)


def flatten(bronze: DataFrame, spec: FeedSpec, keep: tuple[str, ...] = ()) -> DataFrame:
    """The staged view of a feed: declared columns only, one
    ``select`` so Catalyst prunes the nested scan to the leaves used.
    Documents that failed to parse are skipped here; see ``corrupt_documents``.
    """
    if "_corrupt_record" in bronze.columns:
        bronze = bronze.filter(F.col("_corrupt_record").isNull())
    exploded = explode_records(bronze, spec, keep)
    cols = [field_column(f) for f in spec.fields]
    staged = exploded.select(*cols, *[F.col(k) for k in keep])
    if spec.key_expr is not None:
        staged = staged.withColumn(spec.key[0], spec.key_expr())
    return staged
