from strata.sources.bronze import (corrupt_documents, envelope_schema, infer_schema, read_bronze,
                                   start_bronze, stream_landing)
from strata.sources.landing import (document_name, envelope_json, ingestion_metadata,
                                    pages_by_key_range, with_position_pages, partition_folder, to_pages,
                                    write_landing)
from strata.sources.tables import read_current, table, write_table, write_version

__all__ = [
    "corrupt_documents", "document_name", "infer_schema", "envelope_json", "envelope_schema", "ingestion_metadata",
    "pages_by_key_range", "with_position_pages", "partition_folder", "read_bronze", "start_bronze",
    "stream_landing", "table", "to_pages", "write_landing", "write_table",
    "write_version", "read_current",
]
