"""The queries with an SQL equivalent, compared over the same tables."""

from pathlib import Path

import duckdb
import pytest

from arborflow.llm.oracle import STATEMENTS
from arborflow.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(STATEMENTS))
def test_same_rows(spark, sf, name):
    found = QUERIES[name](spark, sf).toPandas()
    with duckdb.connect() as connection:
        for path in Path(sf).glob("*.parquet"):
            connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
        wanted = connection.execute(STATEMENTS[name]).df()
    columns = sorted(found.columns)
    assert columns == sorted(wanted.columns)
    assert sorted(map(str, found[columns].itertuples(index=False, name=None))) == sorted(map(str, wanted[columns].itertuples(index=False, name=None)))
