"""Medallion analytics for supplier master data, written as PySpark DataFrame and streaming jobs."""
