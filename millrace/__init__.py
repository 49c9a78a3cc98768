"""Operational analytics for an online shop, as Spark DataFrame and streaming operators."""
