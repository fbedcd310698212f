"""Column expressions: tokenizers and scalar rules."""
