"""Seller health and anomaly analytics as Spark DataFrame operators."""
