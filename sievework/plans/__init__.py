"""Registered queries over the given tables, with DuckDB twins, and the views both engines share."""


def registered() -> tuple[dict, dict[str, str]]:
    """All queries (name: function of session and folder) and the DuckDB twins of those that SQL can express."""
    from . import analytics, conversation, mining, scoring

    modules = (conversation, scoring, analytics, mining)
    return {k: f for m in modules for k, f in sorted(m.Q.items())}, {k: t for m in modules for k, t in m.SQL.items()}
