"""Readers, writers and materialised intermediate tables."""

from postpulse.sources.tables import (
    POST_SCHEMA,
    TICKER_MAP_SCHEMA,
    local_frame,
    materialise,
    price_range,
    read_posts,
    read_terms,
    read_ticker_map,
    scratch_dir,
    spread,
    unpivot_prices,
    write_table,
)

__all__ = [
    "POST_SCHEMA",
    "TICKER_MAP_SCHEMA",
    "local_frame",
    "materialise",
    "price_range",
    "read_posts",
    "read_terms",
    "read_ticker_map",
    "scratch_dir",
    "spread",
    "unpivot_prices",
    "write_table",
]
