"""Column builders: text in, column out, all of them built-in expressions."""
