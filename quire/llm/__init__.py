"""Operators that prepare text for training data.

Nothing outside this subpackage imports it.  Each module holds the operator of
one problem; ``queries`` names the queries and ``sql`` their SQL twins.
"""
