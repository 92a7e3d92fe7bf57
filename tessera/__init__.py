"""Vision-dataset analytics on Spark DataFrames."""
