"""Operators a training-data pipeline needs, each by one named method.

Nothing else in the library imports this package; ``__spark_entry__.py`` adds
its queries only when the package can be imported.  One module per operator;
:mod:`strata.llm.queries` holds the registered queries and their SQL.
"""
