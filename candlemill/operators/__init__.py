"""Operators that add meaning to plain DataFrame calls."""
