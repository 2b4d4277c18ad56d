"""Operators for preparing language-model training text (see README, "llm")."""
