"""Training-data operators: ten corpus operators and their queries.

Nothing outside this package imports it; ``__spark_entry__.py`` registers its
queries when it can be imported.
"""
