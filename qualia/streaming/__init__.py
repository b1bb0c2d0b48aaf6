"""Rule validation over Structured Streaming sources."""

from qualia.streaming.validate import (  # noqa: F401
    read_stream,
    run_available,
    stream_row_results,
    stream_rule_metrics,
)
