"""DataFrame operators: each takes and returns DataFrames and builds a declarative plan."""
