"""leafmill: a PySpark engine that turns page extractions into typed, analysable resources."""

__version__ = "0.1.0"
