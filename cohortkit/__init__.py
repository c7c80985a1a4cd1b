"""Session-feature and propensity analytics on Spark DataFrames."""
