import datetime
import decimal
import math


def norm(v):
    """Values as the comparison with DuckDB sees them."""
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (int, float, decimal.Decimal)):
        return round(float(v), 6)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def rows_of(rows, names, columns):
    at = [names.index(c) for c in columns]
    return sorted(str(tuple(norm(r[i]) for i in at)) for r in rows)


def same(df, con, sql):
    """Whether a DataFrame and a DuckDB query have the same columns and rows."""
    relation = con.sql(sql)
    columns = sorted(df.columns)
    assert columns == sorted(relation.columns)
    assert rows_of([tuple(r) for r in df.collect()], df.columns, columns) == rows_of(relation.fetchall(), relation.columns, columns)
