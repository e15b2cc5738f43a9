"""Row-by-row comparison of a Spark result with DuckDB's."""

import glob
import math
import os
from collections import Counter

import duckdb

SAME_TYPE = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


def oracle(sql: str, folder: str):
    with duckdb.connect() as db:
        db.execute("SET threads = 4")
        for path in glob.glob(f"{folder}/*.parquet"):
            name = os.path.basename(path).removesuffix(".parquet")
            db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
        result = db.execute(sql)
        names = [d[0] for d in result.description]
        kinds = [str(d[1]) for d in result.description]
        return dict(zip(names, kinds)), result.fetchall(), names


def _plain(value):
    return "NaN" if isinstance(value, float) and math.isnan(value) else value


def _bag(rows, names):
    order = sorted(range(len(names)), key=names.__getitem__)
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def assert_same(df, sql: str, folder: str) -> int:
    kinds, rows, names = oracle(sql, folder)
    ours = {f.name: SAME_TYPE[f.dataType.simpleString()] for f in df.schema}
    assert ours == kinds
    mine, theirs = _bag(df.collect(), df.columns), _bag(rows, names)
    missing, extra = theirs - mine, mine - theirs
    assert not missing and not extra, (list(missing.items())[:3], list(extra.items())[:3])
    return sum(mine.values())
