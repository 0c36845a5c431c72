"""Position-sorted table formats and relational operators for Spark."""
