"""Customer-journey scorecards on Spark."""
