"""Column expressions over path keys and ignore rules."""
