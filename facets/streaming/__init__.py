"""Structured Streaming form of the frequency questions."""

from facets.streaming.frequency import (
    citation_stream,
    cube_answers,
    published,
    running_counts,
    running_cube,
    start_publishing,
    start_top_k,
    table_stream,
)

__all__ = ["citation_stream", "running_counts", "start_top_k", "running_cube", "cube_answers", "start_publishing", "published",
           "table_stream"]
