"""Point-in-time analytics on Spark: facts that get revised, and what was known when."""
