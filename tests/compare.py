"""A Spark result against DuckDB over the same tables."""

from pathlib import Path

import duckdb

DATA = "/root/testdata/sf0.001"


def plain(value):
    if value is None or value != value:
        return "None"
    if isinstance(value, float):
        return f"{round(value, 3) + 0.0:.3f}"
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(map(plain, value)) + "]"
    return str(value)


def duck(sql, data=DATA):
    con = duckdb.connect()
    for p in Path(data).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    got = con.execute(sql)
    return [c[0] for c in got.description], got.fetchall()


def same(df, sql, data=DATA):
    columns, rows = duck(sql, data)
    assert sorted(df.columns) == sorted(columns)
    got = df.select(*columns).collect()
    # numbers on the edge of a rounding step may fall either way, so close ones count as equal
    numeric = lambda r: [x for x in r if isinstance(x, float)]
    rest = lambda r: [plain(x) for x in r if not isinstance(x, float)]
    key = lambda r: (rest(r), [round(x, 2) for x in numeric(r)])
    a, b = sorted(map(tuple, got), key=key), sorted(rows, key=key)
    assert len(a) == len(b)
    for x, y in zip(a, b, strict=True):
        assert rest(x) == rest(y)
        assert all(abs(p - q) <= 2e-5 * max(1, abs(p)) or p != p and q != q for p, q in zip(numeric(x), numeric(y), strict=True)), (x, y)
