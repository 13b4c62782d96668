"""Scalar column helpers (F-01..F-11), dense keys (D-09) and measures (K-39)."""
