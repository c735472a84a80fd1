"""Column functions; built-in expressions unless said otherwise."""
