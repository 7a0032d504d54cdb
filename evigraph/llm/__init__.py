"""Operators for training data: names, ranking, survivors, neighbours, groups, tokens, leakage, truncation.

Nothing outside this subpackage imports it.
"""
