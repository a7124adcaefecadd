"""Column -> Column building blocks. All are built-in expressions; there is no Python UDF."""
