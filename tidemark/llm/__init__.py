"""Operators for training data made from text and vectors.

Nothing outside this subpackage imports it.
"""
