"""Operators on text for language-model data. Nothing else in this package imports it."""
