"""Tables, register files, seeds and feed documents as DataFrames."""
