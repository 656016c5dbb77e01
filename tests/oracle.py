"""Comparison of a query with its SQL."""

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _plain(rows, columns):
    out = []
    for row in rows:
        named = dict(zip(columns, row, strict=True))
        out.append(tuple(str(round(named[c], 9) if isinstance(named[c], float) else named[c]) for c in sorted(named)))
    return sorted(out)


def same(df, sql, sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    rel = con.sql(sql)
    assert sorted(df.columns) == sorted(rel.columns)
    ours, theirs = _plain([tuple(r) for r in df.collect()], df.columns), _plain(rel.fetchall(), rel.columns)
    assert ours == theirs
    return len(ours)
