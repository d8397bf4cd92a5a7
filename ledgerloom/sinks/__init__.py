"""Writers for tables, exports and key lists."""
