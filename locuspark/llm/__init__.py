"""Operators for preparing large text corpora.

Nothing outside this folder imports it. Each module holds one operator with a
general interface; ``queries.py`` registers the thin queries built on them.
"""
