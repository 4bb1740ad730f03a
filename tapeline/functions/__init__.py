"""Column expressions: numbers, codes, times, text, hashes and array folds."""
