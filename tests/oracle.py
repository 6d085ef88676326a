"""Compare a query with its SQL in DuckDB."""

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows_of(frame):
    frame = frame[sorted(frame.columns)].copy()
    for c in frame:
        if frame[c].dtype.kind == "f":
            frame[c] = frame[c].round(6) + 0.0
    values = frame.astype(object).where(frame.notna(), None).itertuples(index=False, name=None)
    plain = lambda v: None if v is None else float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)
    return sorted((tuple(map(plain, r)) for r in values), key=repr)


def expected(sql, sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con.execute(sql).df()


def check(spark, sf_dir, query, sql):
    got, want = query(spark, sf_dir).toPandas(), expected(sql, sf_dir)
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert rows_of(got) == rows_of(want)
