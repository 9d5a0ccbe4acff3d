"""Operators on training data made of text; nothing outside this subpackage imports it."""
