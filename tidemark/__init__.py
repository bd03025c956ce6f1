"""Company intent scoring on Spark."""
