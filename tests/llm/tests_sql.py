"""Comparison of a query's rows with those of its SQL."""


def same_rows(df, con, text):
    found = con.execute(text)
    columns = [d[0] for d in found.description]
    assert sorted(df.columns) == sorted(columns)
    order = sorted(columns)
    mine = sorted(repr(tuple(r[c] for c in order)) for r in df.collect())
    theirs = sorted(repr(tuple(r[columns.index(c)] for c in order)) for r in found.fetchall())
    assert mine and mine == theirs
