"""Tables of the transit pipeline as plans from DataFrames to DataFrames."""
