"""Column-level functions: keyed hashes, text cleanup, tokens, padding, Markdown, scorers."""
