"""Operators of a training-data pipeline over documents, pages and vectors.

Nothing outside this subpackage imports it.  ``queries`` holds the
registered queries; the other modules hold one operator each.
"""
