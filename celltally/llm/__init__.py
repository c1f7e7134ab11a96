"""Training-data operators (texts, tokens, conversations) for large corpora.

Nothing else in the library imports this subpackage; ``queries`` registers its
operators and ``oracle`` holds their DuckDB SQL.
"""
