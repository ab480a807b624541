"""Column expressions and small exact aggregates shared by the operators."""
