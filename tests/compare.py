"""Compare a query with its SQL the way the driver does: columns by name, rows in any order."""

from pathlib import Path

import duckdb


def oracle_rows(sql, sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for p in Path(sf_dir).glob("*.parquet"):
        source = f"{p}/*.parquet" if p.is_dir() else str(p)
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{source}'")
    got = con.execute(sql)
    names = [c[0] for c in got.description]
    return names, got.fetchall()


def plain(v):
    if isinstance(v, float):
        return round(v, 9)
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if isinstance(v, dict):
        return tuple(plain(x) for x in v.values())
    return v


def table_of(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)
    return [names[i] for i in order], sorted(tuple(repr(plain(r[i])) for i in order) for r in rows)


def same(df, sql, sf_dir):
    mine = table_of(df.columns, [tuple(r) for r in df.collect()])
    theirs = table_of(*oracle_rows(sql, sf_dir))
    assert mine[0] == theirs[0], (mine[0], theirs[0])
    assert len(mine[1]) == len(theirs[1]), (len(mine[1]), len(theirs[1]))
    differ = [(a, b) for a, b in zip(mine[1], theirs[1]) if a != b]
    assert not differ, differ[:3]
    return len(mine[1])
