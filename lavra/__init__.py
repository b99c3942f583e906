"""lavra - tabular analytics jobs (clean, enrich, rank, model, explain) on Spark DataFrames."""
