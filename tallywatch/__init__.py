"""Transaction-risk analytics on PySpark, for batch tables and streams."""
