"""Operators for preparing language-model training data.

Each module holds one operator with a general interface; :mod:`lakeops.llm.queries`
applies them to the given tables.  Nothing outside this subpackage imports it.
"""
