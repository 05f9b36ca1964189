"""Layered analytics tables on Spark: Bronze feeds, Silver tables, Gold models."""
