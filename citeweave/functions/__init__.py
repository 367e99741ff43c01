"""Column expressions, all built in except the encoder."""
