"""Warehouse operators: staging (G), star schema (D), enterprise model (M),
profiling/audit (P, A, C), quality checks (Q), publication (V), KPIs (K)."""
