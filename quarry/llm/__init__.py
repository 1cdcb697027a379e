"""Operators of a large-scale training-data pipeline.

Ten operators, each in a module of its own with a general interface, and
``queries``: the registered queries (operators bound to the test tables with
production parameters) and their SQL.  Nothing outside this package imports
it; ``corpus_pipeline.py`` at the repository's top chains five of them.
"""
