"""DataFrame to DataFrame operators. None collects its input; none needs more of a key's rows at once than its docstring says."""
