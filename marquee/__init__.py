"""Film and television catalogue analytics on PySpark DataFrames."""
