"""Data products: compositions of the operators, one Spark plan each."""
