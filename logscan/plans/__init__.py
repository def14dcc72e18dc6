"""Composed plans: fit (M5), detect and batch runs (M6), driver queries with their oracles."""
