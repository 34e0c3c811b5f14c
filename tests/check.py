"""Compare a registered query with its SQL, ordering rows by their values."""

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    con.execute("SET memory_limit = '6GB'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _key(row):
    return tuple((v is None, str(type(v)) if v is None else "", v if v is not None else 0) for v in row)


def spark_rows(df):
    names = sorted(df.columns)
    return names, sorted((tuple(r) for r in df.select(*[f"`{n}`" for n in names]).collect()), key=_key)


def sql_rows(con, sql):
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = cur.fetchall()
    return [columns[i] for i in order], sorted((tuple(r[i] for i in order) for r in rows), key=_key)


def difference(df, con, sql):
    """None if equal, else a short description."""
    names, left = spark_rows(df)
    others, right = sql_rows(con, sql)
    if names != others:
        return f"columns {names} / {others}"
    if len(left) != len(right):
        return f"{len(left)} rows / {len(right)} rows; {left[:2]} / {right[:2]}"
    for a, b in zip(left, right):
        for x, y in zip(a, b):
            if type(x) is not type(y):
                return f"types differ: {a} / {b}"
            if x != y and not (isinstance(x, float) and math.isclose(x, y, rel_tol=0, abs_tol=1e-12)):
                return f"{a} / {b}"
    return None
