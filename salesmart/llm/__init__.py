"""Operators for preparing training text at scale.

Each module holds one operator with its own general interface; ``queries`` holds the thin
registered queries over the given tables and ``oracle`` their DuckDB SQL. Nothing outside
this subpackage imports it.
"""
