"""Runs a query and its DuckDB SQL over the same Parquet files and compares the rows."""

from pathlib import Path

import duckdb


def rows(values):
    def cell(v):
        if isinstance(v, float):
            return repr(round(v, 6))
        return str(v)

    return sorted(tuple(cell(v) for v in r) for r in values)


def connect(folder, temp):
    c = duckdb.connect(config={"temp_directory": str(temp), "threads": 2})
    for p in Path(folder).iterdir():
        c.execute(f"CREATE VIEW {p.name.split('.')[0]} AS SELECT * FROM '{p}'")
    return c


def compare(df, c, sql):
    names = sorted(df.columns)
    mine = rows(df.select(*[f"`{n}`" for n in names]).collect())
    found = c.execute(f"SELECT {', '.join(names)} FROM ({sql})")
    theirs = rows(found.fetchall())
    assert len(mine) == len(theirs)
    assert mine == theirs
