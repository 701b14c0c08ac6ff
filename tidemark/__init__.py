"""Point-in-time market analytics on PySpark."""
