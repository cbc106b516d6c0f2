"""Short-text embedding, margin classification and nearest-neighbour jobs on Spark DataFrames."""
