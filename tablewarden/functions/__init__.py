"""Column expressions: text in, standard value out. No Python UDFs."""
