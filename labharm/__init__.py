"""labharm: harmonisation of laboratory measurements on Spark DataFrames."""
