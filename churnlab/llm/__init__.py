"""Operators for preparing language-model training data.

Nothing else in the library imports this subpackage. Every operator takes and
returns DataFrames; ``registry`` wires them to the test tables as queries.
"""
