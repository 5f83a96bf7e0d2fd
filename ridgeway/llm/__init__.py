"""Operators for preparing training data at scale.

Each module holds one operator with its own general interface; ``queries``
registers one query per operator and their DuckDB SQL where SQL can say it.
Nothing else in the library imports this subpackage.
"""
