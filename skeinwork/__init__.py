"""skeinwork: text-to-graph analytics on PySpark DataFrames."""
