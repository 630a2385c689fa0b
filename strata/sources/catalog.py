"""Catalog tables laid out by key.

A table that is written once in buckets of its key is read without an exchange by
everything that groups, ranks or joins on that key: latest per key, and joins of a
fact with a dimension bucketed alike.  Tables are external (``path``) and named in the
session's catalog; a bucket is one file, sorted by key.

A bucket is also one task, so this layout is for keys without hot values: where one
key may hold a large part of all rows, leave the table unbucketed and use the plans
that reduce before they shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def save_bucketed(df: DataFrame, name: str, keys: Sequence[str], buckets: int, path: str) -> DataFrame:
    """Write ``df`` as catalog table ``name`` in ``buckets`` by ``keys`` and return it."""
    (df.repartition(buckets, *keys).write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys)
     .option("path", path).format("parquet").saveAsTable(name))
    return df.sparkSession.table(name)
