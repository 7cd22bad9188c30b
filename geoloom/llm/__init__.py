"""Operators for preparing training text, built on the library's general helpers.

Nothing outside this package imports it.
"""
