"""Operators for training-data pipelines; queries are in ``riskspark.llm.queries``."""
