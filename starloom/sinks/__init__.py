"""Writers. Files are committed by Spark, so a lost executor leaves no partial result."""
