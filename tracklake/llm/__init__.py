"""Operators of a training-data pipeline over text, vectors and chats.

Nothing else in the library imports this subpackage. ``suite.py`` names the
queries; each operator module states its method, its results on odd input and
its limits.
"""
