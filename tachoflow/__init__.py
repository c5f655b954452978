"""Vehicle-sensor analytics on Spark: bronze, silver and gold layers, batch and streaming."""
