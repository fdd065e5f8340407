"""Column expressions with the tolerant null rules the jobs need."""

from candlemill.functions.dates import compact_date, parse_compact_date, window_list, years_before
from candlemill.functions.text import clean_event_time, is_blank, last_segment
from candlemill.functions.ratio import percent_of

__all__ = [
    "clean_event_time",
    "compact_date",
    "is_blank",
    "last_segment",
    "parse_compact_date",
    "percent_of",
    "window_list",
    "years_before",
]
