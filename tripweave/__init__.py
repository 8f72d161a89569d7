"""Mobility analytics on PySpark: typed trip tables, typical days, gravity model."""
