"""DataFrame operators for news-and-market risk analytics on Spark."""

__all__ = ["constants", "schemas", "session", "common", "fixtures"]
