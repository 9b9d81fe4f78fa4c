"""Retail star-schema warehouse built from Spark DataFrame operators and jobs."""
