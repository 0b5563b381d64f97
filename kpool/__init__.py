"""kpool: mergeable fixed-size uniform samples as Spark DataFrame plans."""

from kpool.functions.strings import random_string
from kpool.functions.tags import draw, priority, row_priority
from kpool.operators.audit import count_by, inclusion_audit, parity
from kpool.operators.merge import merge_summaries, merge_weighted, permute_items
from kpool.operators.ordinal import ordinal
from kpool.operators.pairing import pair_latest_unmatched
from kpool.operators.reservoir import (reservoir_as_of, reservoir_by_key, reservoir_candidates,
                                       reservoir_history, reservoir_replay, reservoir_summary)
from kpool.operators.sample import sample_by_key, sample_k
from kpool.operators.summary import build_summary, explode_summary, render_summary
from kpool.sources.generators import integer_range, random_strings
from kpool.sources.messages import read_messages, summary_payload, write_summaries

__all__ = [
    "build_summary", "count_by", "draw", "explode_summary", "inclusion_audit", "integer_range",
    "merge_summaries", "merge_weighted", "ordinal", "pair_latest_unmatched",
    "parity", "permute_items", "priority", "random_string", "random_strings", "read_messages",
    "render_summary", "reservoir_as_of", "reservoir_by_key", "reservoir_candidates",
    "reservoir_history", "reservoir_replay", "reservoir_summary", "row_priority", "sample_by_key",
    "sample_k", "summary_payload", "write_summaries",
]
