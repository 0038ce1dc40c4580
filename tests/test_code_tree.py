"""code_tree on parts of its own: keys that files share are linked by place, null keys not at all."""

import duckdb

from codetide.plans.catalog import ORACLES, QUERIES


def test_tree_of_own_and_shared_keys(spark, tmp_path):
    parts = [(1, "Brand#1", 4), (2, "Brand#1", 5), (3, "Brand#2", 6), (4, "Brand#2", 7), (5, None, 7), (2, "Brand#1", 5)]
    rows = spark.createDataFrame(parts, "p_partkey bigint, p_brand string, p_size int")
    rows.write.parquet(f"{tmp_path}/part.parquet")
    got = sorted(map(tuple, QUERIES["code_tree"](spark, str(tmp_path)).select("file_path", "node_id", "parent_id", "anchor").collect()))
    with duckdb.connect() as con:
        con.execute(f"create view part as select * from '{tmp_path}/part.parquet/*.parquet'")
        want = sorted(con.execute(ORACLES["code_tree"]).fetchall())
    assert got == want and {r[0] for r in got} == {f"src/m{i}.py" for i in range(1, 5)}
    # each of both files of a shared key meets the parents of both
    edges = [r for r in got if r[0] == "src/m2.py"]
    assert {edges.count(r) for r in edges} == {4}
