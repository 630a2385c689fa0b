"""What landed documents hold: feeds drafted from pages, columns that appear later.

Feeds run on declared schemas; this module finds what to declare.  Documents are
read as variants, which keep every document's own shape, so nothing is lost where
one file holds a lone object and another an array (a plain JSON reader would settle
on ``string`` there).

* ``draft_feed`` walks from the payload down to the record list, merges the schemas of
  all records (``schema_of_variant_agg``) and types text leaves by what they hold.
* ``appeared`` finds fields that the feed does not declare, in its records and in
  ``unknown`` (envelope and resource); ``evolve`` adds them to the feed as typed
  columns.  Rows that lack a field read it as NULL.
* ``remember`` and ``recall`` keep the columns found in a small stored table, so the
  next run starts from the evolved feed.

Only schemas, field names and counts reach the driver: their number is that of the
feed's fields, not of its rows.
"""

from __future__ import annotations

import dataclasses
import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructField, StructType, VariantType

from strata.functions.typed import parse
from strata.session import scratch_path
from strata.sources.bronze import CORRUPT, UNKNOWN
from strata.spec import FeedSpec, Field

ENVELOPE, RESOURCE = "?envelope.", "?resource."
# Variant leaf types and the parser a column of theirs gets.
KINDS = {"bigint": "long", "double": "double", "boolean": "boolean", "string": "string"}


def snake(path: str) -> str:
    """``Departure.AirportCode`` -> ``departure_airport_code``."""
    return re.sub(r"\W+", "_", re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", path)).strip("_").lower()


def variant_type(text: str) -> DataType:
    """The Spark type of a variant schema's text."""
    return DataType.fromDDL(re.sub(r"(^|: |<)OBJECT<", r"\1STRUCT<", text).replace("OBJECT<>", "STRUCT<>"))


def leaves(schema: StructType, at: str = "") -> list[tuple[str, DataType]]:
    """(path, type) of everything that is not an object itself."""
    out = []
    for f in schema.fields:
        path = f"{at}{f.name}"
        out += leaves(f.dataType, f"{path}.") if isinstance(f.dataType, StructType) else [(path, f.dataType)]
    return out


def as_text(schema: StructType) -> StructType:
    """The same objects with text leaves, as records are declared."""
    return StructType([StructField(f.name, as_text(f.dataType) if isinstance(f.dataType, StructType) else StringType())
                       for f in schema.fields])


def record_texts(raw: Column) -> Column:
    """The record list's raw text as one text a record, for an array or a lone object."""
    return F.when(raw.startswith("{"), F.array(raw)).otherwise(F.from_json(raw, ArrayType(StringType())))


def merged_schema(records: DataFrame, text: str) -> StructType:
    """One schema for all records in column ``text``; unparsable ones are left out."""
    found = records.agg(F.schema_of_variant_agg(F.try_parse_json(text))).first()[0]
    kind = variant_type(found) if found and found != "VOID" else StructType([])
    if not isinstance(kind, StructType):
        raise ValueError(f"records are not objects: {found}")
    return kind


def in_document_order(records: DataFrame, text: str, schema: StructType) -> StructType:
    """``schema`` with the fields of every object in the order documents show them.

    A field's place is its average position in the objects that hold it: one aggregate
    a field, all in one pass, and no row a field of every record."""
    places = {}

    def places_of(s: StructType, at: str) -> None:
        names = F.json_object_keys(F.col(text) if at == "$" else F.get_json_object(text, at))
        for f in s.fields:
            places[f"{at}['{f.name}']"] = F.avg(F.nullif(F.array_position(names, F.lit(f.name)), F.lit(0).cast("bigint")) - 1)
            if isinstance(f.dataType, StructType):
                places_of(f.dataType, f"{at}['{f.name}']")

    places_of(schema, "$")
    row = records.agg(*[c.alias(f"p{i}") for i, c in enumerate(places.values())]).first() if places else ()
    place = dict(zip(places, row))

    def ordered(s: StructType, at: str) -> StructType:
        fields = sorted(s.fields, key=lambda f: (place[f"{at}['{f.name}']"] or 0, f.name))
        return StructType([StructField(f.name, ordered(f.dataType, f"{at}['{f.name}']") if isinstance(f.dataType, StructType) else f.dataType)
                           for f in fields])

    return ordered(schema, "$")


def record_path(documents: DataFrame, text: str = "document") -> str:
    """``payload.<Resource>.<Plural>.<Singular>``: the list that holds most records."""
    spark = documents.sparkSession
    parsed = documents.select(F.try_parse_json(text).alias("v"))
    found = spark.sql("""
        SELECT r.key AS resource, p.key AS plural, s.key AS singular,
               sum(coalesce(size(try_variant_get(s.value, '$', 'array<variant>')),
                            CASE WHEN try_variant_get(s.value, '$', 'map<string,variant>') IS NOT NULL THEN 1 END)) AS records
        FROM {docs} d, LATERAL variant_explode(try_variant_get(d.v, '$.payload', 'variant')) r,
             LATERAL variant_explode(r.value) p, LATERAL variant_explode(p.value) s
        WHERE r.key IS NOT NULL AND p.key IS NOT NULL AND s.key IS NOT NULL AND p.key <> 'Meta'
        GROUP BY ALL HAVING records IS NOT NULL ORDER BY records DESC, resource, plural, singular LIMIT 1""", docs=parsed).first()
    if found is None:
        raise ValueError("no document holds a record list")
    return f"payload.{found.resource}.{found.plural}.{found.singular}"


# What a text leaf may be, most special first: all its values must parse.  Times are
# tried where a leaf is no number, as texts that are none are slow to turn down.
TEXT_KINDS = (("int", "long", "double"), ("ts_utc", "ts_local"))


def text_kinds(records: DataFrame, text: str, schema: StructType) -> dict[str, str]:
    """A kind for each text leaf, by what all of its values parse as."""
    paths = [p for p, t in leaves(schema) if isinstance(t, StringType)]
    node = records.select(F.from_json(text, as_text(schema)).alias("n"))
    found, left = {}, paths
    for kinds in TEXT_KINDS:
        parts = {}
        for i, path in enumerate(left):
            value = F.col("n." + ".".join(f"`{x}`" for x in path.split(".")))
            parts[f"v{i}"] = F.count(value)
            for kind in kinds:
                parts[f"{kind}{i}"] = F.count(parse(kind, value))
        row = node.agg(*[c.alias(n) for n, c in parts.items()]).first() if parts else None
        for i, path in enumerate(left):
            found[path] = next((k for k in kinds if row[f"v{i}"] and row[f"{k}{i}"] == row[f"v{i}"]), "string") if row[f"v{i}"] else None
        left = [p for p in left if found[p] == "string"]
    return {p: found[p] or "string" for p in paths}


def draft_feed(documents: DataFrame, name: str, category: str, key: Sequence[str],
               column: Callable[[str], str] = snake, text: str = "document", **options) -> FeedSpec:
    """A feed's declaration from its landed ``documents``.

    ``key`` names the record fields of the key; whole numbers there are drafted as
    ``long``, since keys outgrow what has landed so far.  ``column`` names a path's
    column; further ``options`` are those of ``FeedSpec``."""
    path = record_path(documents, text)
    raw = F.get_json_object(text, "$." + path)
    # Cut from their documents once; the passes below read the stored records.
    cut = scratch_path(documents.sparkSession, f"records-{name}")
    documents.select(F.explode(record_texts(raw)).alias("record")).write.option("compression", "zstd").parquet(cut)
    records = documents.sparkSession.read.parquet(cut)
    found = in_document_order(records, "record", merged_schema(records, "record"))
    kinds = text_kinds(records, "record", found)

    def kind(p: str, t: DataType) -> str:
        k = kinds.get(p) or _kind(t)
        return "long" if k == "int" and p in key else k

    fields = tuple(Field(column(p), p, kind(p, t)) for p, t in leaves(found))
    return FeedSpec(name=name, category=category, array_path=path, node_schema=as_text(found), fields=fields,
                    key=tuple(column(k) for k in key), **options)


def _kind(t: DataType) -> str:
    if t.typeName() == "decimal":
        return "double"
    return KINDS.get(t.simpleString(), "string")


def appeared(bronze: DataFrame, spec: FeedSpec) -> list[Field]:
    """Fields of ``bronze`` that ``spec`` does not declare, typed by all their values: of
    the records, and of envelope and resource where ``unknown`` kept them."""
    good = bronze.where(F.col(CORRUPT).isNull()) if CORRUPT in bronze.columns else bronze
    records = good.select(F.explode(record_texts(F.col(spec.array_path))).alias("record"))
    declared = {p for p, _ in leaves(spec.node_schema)}
    groups = {p.rpartition(".")[0] for p in declared}
    out = []
    for path, t in leaves(merged_schema(records, "record")):
        # What is declared as one text may be an object inside.
        inside = any(path.startswith(f"{d}.") for d in declared)
        if path not in declared and not inside and not any(g == path or g.startswith(f"{path}.") for g in groups):
            out.append(Field(snake(path), path, _kind(t)))
    if spec.keep_unknown and UNKNOWN in bronze.columns:
        named = {"ingestion_metadata", "payload"}
        for place, prefix in (("envelope", ENVELOPE), ("resource", RESOURCE)):
            rows = good.select(F.explode(f"{UNKNOWN}.{place}").alias("name", "value"))
            types = rows.where(~F.col("name").isin(*named, "Meta")).groupBy("name").agg(
                F.schema_of_variant_agg(F.coalesce(F.try_parse_json("value"), F.to_variant_object(F.array("value")))).alias("t"))
            for r in types.orderBy("name").collect():  # a row a field
                t = variant_type(r.t) if r.t != "VOID" else StringType()
                out.append(Field(snake(r.name), prefix + r.name, "string" if isinstance(t, (StructType, ArrayType, VariantType)) else _kind(t)))
    known = {f.path for f in spec.fields}
    taken = {f.name for f in spec.fields}
    return [dataclasses.replace(f, name=f.name if f.name not in taken else f"{f.name}_new") for f in out if f.path not in known]


def _with_leaf(schema: StructType, path: list[str]) -> StructType:
    name, rest = path[0], path[1:]
    old = next((f for f in schema.fields if f.name == name), None)
    if not rest:
        return schema if old else StructType([*schema.fields, StructField(name, StringType())])
    inner = _with_leaf(old.dataType if old and isinstance(old.dataType, StructType) else StructType([]), rest)
    fields = [StructField(name, inner) if f.name == name else f for f in schema.fields]
    return StructType(fields if old else [*fields, StructField(name, inner)])


def evolve(spec: FeedSpec, found: Sequence[Field]) -> FeedSpec:
    """``spec`` with the fields found as further columns."""
    node = spec.node_schema
    for f in found:
        if not f.path.startswith(("?", "@")):
            node = _with_leaf(node, f.path.split("."))
    return dataclasses.replace(spec, node_schema=node, fields=spec.fields + tuple(found))


_FOUND = "feed string, name string, path string, kind string"


def remember(spark: SparkSession, path: str, spec: FeedSpec, found: Sequence[Field]) -> None:
    """Add the columns found for a feed to the table at ``path``."""
    if found:
        rows = [(f"{spec.category}/{spec.name}", f.name, f.path, f.kind) for f in found]
        spark.createDataFrame(rows, _FOUND).coalesce(1).write.mode("append").parquet(path)


def recall(spark: SparkSession, path: str, spec: FeedSpec) -> FeedSpec:
    """``spec`` with all columns remembered for it; without the table, ``spec`` itself."""
    from pyspark.errors import AnalysisException

    try:
        rows = spark.read.schema(_FOUND).parquet(path).where(F.col("feed") == f"{spec.category}/{spec.name}")
        rows = rows.distinct().orderBy("name").collect()  # a row a field
    except AnalysisException:
        return spec
    known = {f.path for f in spec.fields}
    return evolve(spec, [Field(r.name, r.path, r.kind) for r in rows if r.path not in known])
