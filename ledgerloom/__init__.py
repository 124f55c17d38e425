"""History-keeping analytics for banking tables on PySpark DataFrames."""
