"""Plan-level helpers: sessions, lineage cuts, skew-safe joins and distributed numbering."""
