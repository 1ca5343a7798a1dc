"""Helpers to compare answers."""


def plain(df, *columns):
    """Rows as sorted tuples."""
    rows = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
    return sorted(rows, key=lambda row: [(v is not None, str(type(v)), v) if not isinstance(v, (list, bytes)) else (True, "", str(v)) for v in row])
