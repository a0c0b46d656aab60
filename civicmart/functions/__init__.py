"""Column expressions (JVM-side, codegen-friendly); no Python UDFs."""

from civicmart.functions.metrics import intensity_level, rate_per_100k, variation_pct
from civicmart.functions.parse import (
    event_year,
    null_if_missing,
    parse_event_ts,
    round_half_even_long,
    to_integer,
    to_number,
)

__all__ = [
    "event_year", "intensity_level", "null_if_missing", "parse_event_ts", "rate_per_100k",
    "round_half_even_long", "to_integer", "to_number", "variation_pct",
]
