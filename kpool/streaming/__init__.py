"""Streaming forms: batch-level summaries (foreachBatch) and the element-level
paired stream (transformWithStateInPandas)."""

from kpool.streaming.paired import paired_sample_stream, run_paired_stream
from kpool.streaming.sample_stream import latest_summary, stream_merge, stream_sample

__all__ = ["latest_summary", "paired_sample_stream", "run_paired_stream", "stream_merge", "stream_sample"]
