"""Column expressions: no DataFrame, no state, everything inside code generation."""
