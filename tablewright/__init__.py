"""Versioned-table analytics on PySpark: operators that take DataFrames and return DataFrames."""
