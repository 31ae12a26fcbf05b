"""Structured Streaming: the cleaning stage applied to raw contact files as they arrive.

The published pipeline is a daily batch; its row-level stage (rename, clean,
derive, filter) is stateless, so the same Column expressions run unchanged on a
streaming DataFrame. Aggregates, ranks and checks stay batch jobs over the
written clean table.
"""

from dialstat.streaming.incremental import clean_stream, start_clean_stream

__all__ = ["clean_stream", "start_clean_stream"]
