"""Column-to-Column functions. Nothing here needs a Python UDF."""
