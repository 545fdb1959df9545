"""Marketplace analytics on PySpark: orders, delivery, sellers, quality checks and a late-delivery model."""
