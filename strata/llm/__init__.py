"""Operators for preparing training data: thirteen DataFrame operators, their queries and SQL twins.

Nothing else in the library imports this subpackage.
"""
