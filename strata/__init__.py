"""strata: a Spark-native, config-driven medallion toolkit (bronze, silver, gold)."""

from strata.session import checkpoint_root, ensure_utc, get_session, scratch_path
from strata.spec import Dim, FeedSpec, Field, Rule

__all__ = ["Dim", "FeedSpec", "Field", "Rule", "checkpoint_root", "ensure_utc", "get_session",
           "scratch_path"]
