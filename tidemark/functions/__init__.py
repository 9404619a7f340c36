"""Column functions: canonical text, strict parsing, plain numbers, names."""
