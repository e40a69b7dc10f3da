"""Column expressions: text to tokens, sets, hash families."""
