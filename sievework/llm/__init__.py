"""Training-data pipeline operators: each module holds one operator and its thin query.

Nothing else in the library imports this package; ``llm.queries`` collects the
registered queries and their DuckDB twins.
"""
