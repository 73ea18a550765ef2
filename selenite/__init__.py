"""Raster-anomaly analytics on Spark: relational operators, raster kernels, query phrases and streams."""
