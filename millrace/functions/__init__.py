from millrace.functions.columns import (
    DEFAULT_RATE,
    DISTANCE_BANDS,
    LENIENT_DATES,
    PRIORITY_LABELS,
    STRICT_DATES,
    convert_currency,
    decode_labels,
    distance_length,
    label_equal,
    label_ranges,
    label_up_to,
    lead_time_days,
    parse_date,
    passenger_load_exact,
    passenger_load_threshold,
    to_bigint,
    to_int,
    to_text,
    to_timestamp,
)

__all__ = [
    "DEFAULT_RATE",
    "DISTANCE_BANDS",
    "LENIENT_DATES",
    "PRIORITY_LABELS",
    "STRICT_DATES",
    "convert_currency",
    "decode_labels",
    "distance_length",
    "label_equal",
    "label_ranges",
    "label_up_to",
    "lead_time_days",
    "parse_date",
    "passenger_load_exact",
    "passenger_load_threshold",
    "to_bigint",
    "to_int",
    "to_text",
    "to_timestamp",
]
