"""Airport traffic analytics on Spark: raw flight records to punctuality marts."""
