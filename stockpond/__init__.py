"""Retail lakehouse analytics on PySpark: Bronze / Silver / Gold as DataFrame functions."""
