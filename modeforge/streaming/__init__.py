"""The encoders on streaming DataFrames."""
