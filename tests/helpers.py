"""Order-free comparison of a DataFrame with a DuckDB result."""

import math


def cell(x):
    if isinstance(x, float):
        return None if math.isnan(x) else float(f"{x:.9g}")
    if isinstance(x, list | tuple):
        return tuple(map(cell, x))
    if hasattr(x, "asDict"):
        return tuple(sorted((k, cell(v)) for k, v in x.asDict().items()))
    if isinstance(x, dict):
        return tuple(sorted((k, cell(v)) for k, v in x.items()))
    return x


def same(df, relation):
    names = sorted(df.columns)
    assert sorted(d[0] for d in relation.description) == names
    at = [[d[0] for d in relation.description].index(n) for n in names]
    got = sorted(repr(tuple(cell(r[n]) for n in names)) for r in df.collect())
    want = sorted(repr(tuple(cell(r[i]) for i in at)) for r in relation.fetchall())
    assert got == want
