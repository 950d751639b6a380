"""Review analytics on Spark: profiling, cleaning, training, scoring and reporting."""
