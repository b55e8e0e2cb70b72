"""Table operators for lakehouse work on PySpark."""
