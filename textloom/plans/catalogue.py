"""All queries. Importing the thematic modules registers them."""

from textloom.plans import artifact_queries, chat_queries, dedup_queries, judge_queries, line_queries, sampling_queries, source_queries, stats_queries, stream_queries, text_queries  # noqa: F401
from textloom.plans.registry import ORACLES, QUERIES  # noqa: F401
