"""ELT building blocks and batch jobs on PySpark DataFrames."""
