"""Area-level incident statistics on PySpark DataFrames."""
