"""Operators on tall tables of observations."""
