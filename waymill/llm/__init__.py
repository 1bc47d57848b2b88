"""Operators for preparing training data.

Each operator is a function from DataFrame to DataFrame with its own parameters; the
queries over the test tables are in ``queries``.  Nothing outside this folder imports it.
"""
