"""Market-data lake on Spark: capture, sealing, universe resolution, option metrics and checks."""
