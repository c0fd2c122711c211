"""Hierarchical listings and the annotated text trees that document them, as Spark DataFrames."""
