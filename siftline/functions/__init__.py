"""Column expressions. Python runs only where a docstring says so."""
