"""shopwright: a retail warehouse (staging, star schema, enterprise model,
quality checks, publication checks and KPIs) expressed as Spark DataFrame
operators.

Every operator is a plain function ``DataFrame(s) -> DataFrame`` built from
native column expressions, so Catalyst can prune, push down and plan it.
"""

__version__ = "0.1.0"
