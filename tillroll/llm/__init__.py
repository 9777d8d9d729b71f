"""Operators for large-scale training-data pipelines.

Self-contained: nothing else in the library imports this subpackage.
"""
