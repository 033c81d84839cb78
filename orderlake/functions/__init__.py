"""Column expressions shared by the operators. All are built from Spark's own functions."""
