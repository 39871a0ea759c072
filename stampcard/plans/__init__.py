"""User-level pipelines, put together from the operators."""
