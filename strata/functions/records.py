"""Record lists inside feed documents: object-or-array normalisation.

The feed returns a single record as an object and several as an array.  The
bronze reader keeps the record list as raw JSON text; ``record_array`` parses it
with an array schema, which wraps a lone object into a one-element array and
yields NULL for NULL or malformed text (SURVEY N2).
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql.types import ArrayType, StructType


def record_array(raw: Column | str, node_schema: StructType) -> Column:
    c = F.col(raw) if isinstance(raw, str) else raw
    return F.from_json(c, ArrayType(node_schema))


def record_count(raw: Column | str) -> Column:
    """Records in one document's raw list, without parsing their fields: the
    length of an array, 1 for a lone object, 0 for an empty or missing list."""
    c = F.col(raw) if isinstance(raw, str) else raw
    lone = F.when(c.startswith("{"), F.lit(1))
    return F.coalesce(F.json_array_length(c), lone, F.lit(0)).cast("bigint")


def en_name(node: str, path: str = "Names") -> Column:
    """The English name held under a ``$`` field (``Names.Name.$``)."""
    return F.col(f"{node}.{path}.Name.`$`")
