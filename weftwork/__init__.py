"""Data-analysis operators on Spark DataFrames and Structured Streaming."""

from weftwork.session import build_session, checkpointed, scratch_path

__all__ = ["build_session", "checkpointed", "scratch_path"]
