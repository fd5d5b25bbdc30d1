"""Column functions: text normalisation, tokenising and small scalar helpers."""
