"""tessera: corpus analytics on Spark DataFrames."""
