"""Operators for preparing language-model training data.

Nothing else in the library imports this subpackage. Each module holds one operator; ``queries`` registers
one query per operator and the corpus pipeline.
"""
