"""Layered analytics tables (raw, cleaned, star schema) as Spark DataFrame jobs."""
