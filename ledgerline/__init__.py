"""Line feeds, archives, identifier merges and delivery reports on Spark DataFrames."""
