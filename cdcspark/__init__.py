"""Change-data capture and corpus preparation as PySpark DataFrame operators."""
