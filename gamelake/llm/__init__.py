"""Operators for preparing large text and vector corpora (one module per operator)."""
