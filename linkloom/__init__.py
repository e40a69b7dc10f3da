"""Record linkage and text similarity on Spark DataFrames."""
