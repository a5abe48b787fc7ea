from millrace.operators.dimension import dimension, dimensions, surrogate_key
from millrace.operators.items import count_distinct_items, explode_delimited
from millrace.operators.keys import keys_present
from millrace.operators.lookup import BROADCAST_ROWS, fit_broadcast, join_lookup, join_lookup_split
from millrace.operators.names import fresh_name
from millrace.operators.sequence import sequence_id, sequence_ids

__all__ = [
    "BROADCAST_ROWS",
    "count_distinct_items",
    "dimension",
    "dimensions",
    "explode_delimited",
    "fit_broadcast",
    "fresh_name",
    "join_lookup",
    "join_lookup_split",
    "keys_present",
    "sequence_id",
    "sequence_ids",
    "surrogate_key",
]
