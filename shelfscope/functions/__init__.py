"""Column -> Column functions (plus two small Arrow helpers for markup and image headers)."""
