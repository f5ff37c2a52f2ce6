"""Column functions: text, numbers and the fixed values that they use."""
