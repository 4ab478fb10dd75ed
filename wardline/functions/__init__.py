"""Column expressions: Column or column name in, Column out."""
