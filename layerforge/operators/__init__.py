"""Load operators: DataFrames in, DataFrame out."""
