"""Layered sales and card-fraud analytics on the public PySpark API."""
