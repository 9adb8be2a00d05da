"""Column functions used by the feeds (phone, address, names, patron class, gates)."""

from feedkit.functions.text import (
    display_name,
    format_phone,
    hour_gate,
    is_current,
    join_lines,
    missing,
    open_on,
    patron_class,
    quoted_field_safe,
    season_suffix,
    still_active,
)

__all__ = [
    "display_name", "format_phone", "hour_gate", "is_current", "join_lines", "missing",
    "open_on", "patron_class", "quoted_field_safe", "season_suffix", "still_active",
]
