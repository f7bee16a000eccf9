"""Column functions: text, arrays, dates, numbers and fingerprints, all from built-in expressions."""
