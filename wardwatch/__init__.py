"""Score, track and watch a stream of patient-vitals events with Spark DataFrames."""
