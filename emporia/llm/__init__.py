"""Operators of a large-scale training-data pipeline.

One module per operator; :mod:`emporia.llm.registry` names the queries.  No
other part of the package imports this one.
"""
