"""Operators: each takes and gives data frames."""
