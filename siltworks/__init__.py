"""Layered table refinement on Spark: raw documents to bronze to silver."""
