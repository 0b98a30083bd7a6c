"""Land prioritisation on Spark: cells, indicators, scores and rankings."""
