from strata.streaming.ingest import bronze_path, ingest_feeds, landing_path
from strata.streaming.latest import latest_aggregate, read_latest, start_latest

__all__ = ["bronze_path", "ingest_feeds", "landing_path", "latest_aggregate", "read_latest", "start_latest"]
