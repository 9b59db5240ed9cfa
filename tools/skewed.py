"""Write a copy of the tables in which single keys hold a third of the rows: skewed.py <from> <to>.

For checking results and plans under skew; the copy is test data, not part of the repository.
"""

from __future__ import annotations

import sys

import duckdb

THIRD = "hash({key} * 7919) % 3 = 0"


def main(source: str, target: str) -> None:
    con = duckdb.connect()
    every = ("region nation customer supplier part orders lineitem events documents embeddings pages "
             "benchmark labels conversations").split()
    hot = {
        "lineitem": "SELECT * REPLACE (CASE WHEN " + THIRD.format(key="l_partkey + l_quantity") + " THEN 8 ELSE l_orderkey END AS l_orderkey, "
                    "CASE WHEN " + THIRD.format(key="l_partkey + l_extendedprice") + " THEN 3 ELSE l_suppkey END AS l_suppkey) FROM t",
        "orders": "SELECT * REPLACE (CASE WHEN " + THIRD.format(key="o_orderkey") + " THEN 5 ELSE o_custkey END AS o_custkey) FROM t",
        "events": "SELECT * REPLACE (CASE WHEN " + THIRD.format(key="event_id") + " THEN 2 ELSE user_id END AS user_id) FROM t",
    }
    for name in every:
        sql = hot.get(name, "SELECT * FROM t")
        con.execute(f"CREATE OR REPLACE VIEW t AS SELECT * FROM read_parquet('{source}/{name}.parquet')")
        con.execute(f"COPY ({sql}) TO '{target}/{name}.parquet' (FORMAT parquet)")


if __name__ == "__main__":
    main(*sys.argv[1:3])
