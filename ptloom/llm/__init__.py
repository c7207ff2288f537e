"""Operators of a training-data pipeline over the tables ``documents``, ``pages``, ``benchmark`` and ``labels``.

One module per operator; ``queries`` registers them.  Nothing else in the
library imports this package.
"""
