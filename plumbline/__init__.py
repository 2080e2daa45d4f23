"""A columnar analytics engine on PySpark."""
