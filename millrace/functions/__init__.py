"""Column functions: money, labels, text and time."""

from millrace.functions.labels import (
    before_image_label,
    display_name,
    loyalty_tier,
    order_priority,
    restock_needed,
)
from millrace.functions.money import (
    effective_price,
    in_usd,
    loyalty_points,
    percent,
    repriced,
    sale_price,
)
from millrace.functions.text import (
    contains_text,
    query_pattern,
    safe_name,
    strip_nul,
    surrogate_key,
)
from millrace.functions.times import (
    epoch_seconds,
    event_time,
    from_micros,
    instant,
    iso_text,
    moment,
    sale_end,
)

__all__ = [
    "before_image_label",
    "contains_text",
    "display_name",
    "effective_price",
    "epoch_seconds",
    "event_time",
    "from_micros",
    "in_usd",
    "instant",
    "iso_text",
    "loyalty_points",
    "loyalty_tier",
    "moment",
    "order_priority",
    "percent",
    "query_pattern",
    "repriced",
    "restock_needed",
    "safe_name",
    "sale_end",
    "sale_price",
    "strip_nul",
    "surrogate_key",
]
