"""Column expressions and small frames shared by the operators."""
