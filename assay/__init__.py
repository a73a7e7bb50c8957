"""Composable PySpark operators for building and checking a medallion data product."""
