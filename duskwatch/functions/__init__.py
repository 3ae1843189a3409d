"""Column helpers: addresses, timestamps, text."""
