"""Directory listings and text as DataFrames."""
