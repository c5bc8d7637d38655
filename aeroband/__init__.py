"""Air-quality analytics on Spark: DataFrame operators and one batch pipeline built from them."""
