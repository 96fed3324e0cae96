"""All registered queries and their DuckDB SQL."""

QUERIES: dict = {}
SQL: dict = {}


def register(name: str, sql: str | None = None):
    """Decorator: adds a query (spark, sf_dir) -> DataFrame under `name`, with its SQL where there is one."""

    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add
