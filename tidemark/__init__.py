"""tidemark: behaviour analytics on Spark DataFrames, SQL and Structured Streaming."""

from tidemark.session import get_spark, checkpoint_root

__all__ = ["get_spark", "checkpoint_root"]
