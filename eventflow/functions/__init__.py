"""Column functions: scalar conversions and formats, tokenizers."""
