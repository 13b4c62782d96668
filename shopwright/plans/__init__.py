"""Build plans: the layered warehouse DAG and the query catalogue."""
