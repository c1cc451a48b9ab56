"""Column expressions: text cleaning, language names, prompts, stable hashing."""
