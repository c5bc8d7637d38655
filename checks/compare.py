"""Run registered queries in Spark and their twins in DuckDB, and compare the rows.

    python -m checks.compare /root/testdata/sf0.01 [query ...]
"""

import sys
import time

import duckdb

from aeroband.session import build_session
from checks import registered, sql

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


# DuckDB's names of Spark's types.
KINDS = {
    "string": "VARCHAR", "double": "DOUBLE", "int": "INTEGER", "bigint": "BIGINT", "boolean": "BOOLEAN", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def plain(row):
    return tuple(round(v, 9) if isinstance(v, float) else v for v in row)


def difference(spark_df, twin) -> str:
    """Empty if columns, their types, and rows regardless of order agree. NULL and NaN are told apart."""
    names = sorted(spark_df.columns)
    ours = sorted((name, KINDS.get(kind, kind)) for name, kind in spark_df.dtypes)
    theirs = sorted(zip(twin.columns, map(str, twin.types)))
    if ours != theirs:
        return f"columns differ: only here {set(ours) - set(theirs)}; only there {set(theirs) - set(ours)}"
    ours = sorted(map(repr, map(plain, spark_df.select(*names).collect())))
    theirs = sorted(map(repr, map(plain, twin.project(", ".join(f'"{n}"' for n in names)).fetchall())))
    if ours == theirs:
        return ""
    only_ours, only_theirs = sorted(set(ours) - set(theirs)), sorted(set(theirs) - set(ours))
    return f"{len(ours)} and {len(theirs)} rows; only here {only_ours[:3]}; only there {only_theirs[:3]}"


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def main(sf_dir, names):
    spark = build_session(
        master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(sf_dir), []
    for name in names or registered.QUERIES:
        start = time.time()
        try:
            df = registered.QUERIES[name](spark, sf_dir)
            problem = difference(df, con.sql(sql.ORACLE[name]))
        except Exception as error:  # a broken query must not hide the state of the others
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{'ok  ' if not problem else 'FAIL'} {name} {time.time() - start:.1f}s {problem}", flush=True)
        failed += [name] if problem else []
    print(f"{len(failed)} failed: {failed}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
