"""Column builders: every function maps columns to a column and stays inside code generation."""
