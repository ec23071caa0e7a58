"""Market-trade analytics as plain DataFrame-in, DataFrame-out functions on Spark."""
