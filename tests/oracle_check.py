"""Compares a query with its SQL twin over the driver's tables."""

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def differences(spark_df, con, sql, show=3):
    """Empty list when equal, else short descriptions."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(spark_df.columns):
        return [f"columns {sorted(spark_df.columns)} != {sorted(names)}"]
    kinds = {d[0]: str(d[1]) for d in result.description}
    mine = _rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    theirs = _rows(names, result.fetchall())
    found = []
    for field in spark_df.schema.fields:
        expected = EXPECTED_TYPES.get(kinds[field.name])
        if expected and field.dataType.simpleString() not in expected:
            found.append(f"type of {field.name}: {field.dataType.simpleString()} != {kinds[field.name]}")
    if len(mine) != len(theirs):
        found.append(f"row count {len(mine)} != {len(theirs)}")
    only_mine, only_theirs = list(set(mine) - set(theirs)), list(set(theirs) - set(mine))
    if only_mine or only_theirs:
        found.append(f"{len(only_mine)} rows only in Spark: {sorted(only_mine, key=repr)[:show]}")
        found.append(f"{len(only_theirs)} rows only in SQL: {sorted(only_theirs, key=repr)[:show]}")
    elif mine != theirs:
        found.append("same rows, different multiplicities")
    return found


EXPECTED_TYPES = {
    "BIGINT": {"bigint"},
    "INTEGER": {"int"},
    "DOUBLE": {"double"},
    "VARCHAR": {"string"},
    "BOOLEAN": {"boolean"},
    "DATE": {"date"},
    "TIMESTAMP": {"timestamp_ntz"},
    "HUGEINT": {"none"},
}
