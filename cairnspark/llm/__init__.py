"""Training-data operators: ten corpus-scale operators, one module each.

Nothing outside this package (and the guarded part of ``__spark_entry__``)
imports it.
"""
