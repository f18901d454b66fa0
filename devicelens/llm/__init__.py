"""Training-data operators on DataFrames: deduplication, filters, tokens, archives.

Each module holds one operator; :mod:`devicelens.llm.queries` registers them.
Nothing else in the library imports this subpackage.
"""
