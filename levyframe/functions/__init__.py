"""Column functions: names, numbers, stacks and geometry, all built-in expressions."""
