"""op1 counts documents, not rows: against its own SQL where rows repeat an id."""

import duckdb

from lotwise.llm import line_dedup, queries

SCHEMA = "doc_id long, text string"


def test_rows_of_one_id_are_one_document(spark):
    rows = [(7, f"Again\nonly {i}") for i in range(10)]
    rows += [(i, f"shared\nown {i}") for i in range(20, 30)] + [(None, f"nobody's\n{i}") for i in range(10)]
    found = line_dedup.digest(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(found) == len(rows)
    dropped = {i: {r.n_dropped for r in found if r.doc_id == i} for i in (7, 20, None)}
    assert dropped == {7: {0}, 20: {1}, None: {0}}


def test_the_oracle_counts_alike(spark):
    # Each id repeats one text, so the rows of an id are as its one row in SQL but for their number.
    rows = [(i % 9, f"line of nine\nown {i % 9}") for i in range(18)]
    rows += [(i, f"line of ten\nown {i}") for i in range(50, 60)]
    duck = duckdb.connect()
    duck.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    duck.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    expected = {r[0]: r[2] > 0 for r in duck.sql(queries.oracle_sql()["op1_line_dedup"]).fetchall()}
    found = line_dedup.digest(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.doc_id: r.n_dropped > 0 for r in found} == expected
    assert set(expected.values()) == {True, False}
