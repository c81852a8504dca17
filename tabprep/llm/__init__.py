"""Operators for preparing large text corpora as Spark jobs.

Nothing outside this subpackage imports it. Each module holds one operator
with a general interface; ``queries`` registers one query per operator.
"""
