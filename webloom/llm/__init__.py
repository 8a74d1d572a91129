"""Training-data operators: one module per operator, queries in ``catalog``.

Nothing outside this subpackage imports it; ``__spark_entry__.py`` adds its
queries when it is present.
"""
