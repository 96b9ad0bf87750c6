from eventloom.streaming.sinks import (
    console_sink,
    dropped_counts,
    each_batch,
    each_record,
    file_sink,
    late_rows,
    run_to_end,
)
from eventloom.streaming.stateful import (
    clock_window_count_stream,
    cumulative_window_count_stream,
    delimiter_segments_stream,
    running_totals_stream,
)

__all__ = [
    "clock_window_count_stream",
    "console_sink",
    "cumulative_window_count_stream",
    "delimiter_segments_stream",
    "dropped_counts",
    "each_batch",
    "each_record",
    "file_sink",
    "late_rows",
    "run_to_end",
    "running_totals_stream",
]
