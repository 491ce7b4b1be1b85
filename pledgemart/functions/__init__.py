"""Column functions. All are built-in expressions except entity unescaping (``text``)."""
