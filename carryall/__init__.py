"""Set-based bulk table migration on Spark: every operator takes and gives DataFrames."""
