"""Comparison of a Spark result with DuckDB's, without regard to order."""


def plain(value):
    if value is None or value != value:
        return "NULL"
    if isinstance(value, bool):
        return str(value)
    if hasattr(value, "item"):
        return plain(value.item())
    return repr(float(value)) if isinstance(value, int | float) else str(value)


def rows_of(frame, columns):
    return sorted(tuple(plain(v) for v in r) for r in frame[columns].itertuples(index=False, name=None))


def assert_same(df, con, sql):
    ours, theirs = df.toPandas(), con.sql(sql).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    columns = sorted(ours.columns)
    assert rows_of(ours.astype(object).where(ours.notna(), None), columns) == rows_of(theirs.astype(object).where(theirs.notna(), None), columns)
