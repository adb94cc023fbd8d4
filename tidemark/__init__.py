"""Layered tables on Spark: change capture, connectors, tested models, quality gates and as-of analytics."""
