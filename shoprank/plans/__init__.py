"""Plans: window arithmetic, end-to-end compositions and Spark ML jobs."""
