"""What the Python workers of the pipeline hold in memory beside their data."""

import subprocess
import sys

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lotwise.llm.common import ROOT, map_groups


@pytest.mark.parametrize("module", ["toxicity", "exact_dedup", "ngram_join", "suffix_dedup", "packing"])
def test_stages_of_the_pipeline_leave_pandas_out(module):
    code = f"import sys, lotwise.llm.{module}; sys.exit('pandas' in sys.modules)"
    assert subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=False).returncode == 0


def test_groups_are_whole(spark):
    def sizes(group: pa.Table) -> pa.Table:
        assert len(set(group["k"].to_pylist())) == 1
        return pa.table({"k": group["k"][:1], "n": [group.num_rows], "s": [sum(group["v"].to_pylist())]})

    rows = spark.range(30_000).select((F.col("id") % 7).alias("k"), F.col("id").alias("v"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    try:
        found = map_groups(rows, "k", sizes, "k long, n long, s long").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    expected = {(k, len(range(k, 30_000, 7)), sum(range(k, 30_000, 7))) for k in range(7)}
    assert {(r.k, r.n, r.s) for r in found} == expected
    assert map_groups(rows.limit(0), "k", sizes, "k long, n long, s long").collect() == []
