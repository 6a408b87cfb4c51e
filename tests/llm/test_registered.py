import re

import __spark_entry__ as entry_point
import check_oracles


def test_every_operator_and_the_pipeline_are_registered():
    keys = entry_point.queries()
    assert {int(m[1]) for k in keys if (m := re.match(r"op(\d+)_", k))} == set(range(1, 14)) and "pipeline" in keys


def test_topk_matches_its_sql(spark, sf_dir):
    con = check_oracles.connect(sf_dir)
    header, got = check_oracles.run_spark(spark, entry_point.queries()["op2_topk"], sf_dir)
    assert (header, got) == check_oracles.run_duckdb(con, entry_point.oracle_sql()["op2_topk"])
