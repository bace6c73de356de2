"""Structured Streaming: the incremental cleansed build."""

from rankflow.streaming.ingest import (  # noqa: F401
    build_snapshots, committed_rankings, start_cleansed_stream,
)
