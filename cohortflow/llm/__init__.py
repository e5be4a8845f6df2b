"""Operators for preparing training data at scale, and their registered queries.

Nothing else in the library imports this subpackage.
"""
