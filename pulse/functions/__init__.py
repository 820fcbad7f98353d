"""Column expressions: text, time and value functions (no UDFs)."""
