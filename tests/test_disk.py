"""What a query leaves on disk beyond, and as, its rows."""

import glob

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from arborflow.plans.queries import QUERIES

CODEC = "spark.sql.parquet.compression.codec"
READ = {"spark.sql.files.maxPartitionBytes": "2k", "spark.sql.files.openCostInBytes": "0"}


@pytest.fixture
def edges(spark):
    """ast_child_edges of a folder, read in small splits."""
    for key, value in READ.items():
        spark.conf.set(key, value)
    spark.conf.unset(CODEC)
    yield lambda folder: QUERIES["ast_child_edges"](spark, str(folder))
    for key in (*READ, CODEC):
        spark.conf.unset(key)


def documents(folder, rows, in_group):
    """One file; neighbouring ids, a null and a repeated one."""
    ids = [None, 1, *range(1, rows - 1)]
    texts = [f"{'x' * (n % 7)}\n" + "line of words " * 20 + f'{n} "\\\n' for n in range(rows)]
    table = pa.table({"doc_id": ids, "text": texts, "lang": ["en"] * rows, "source": ["src1"] * rows, "n_chars": [len(t) for t in texts]})
    folder.mkdir()
    pq.write_table(table, folder / "documents.parquet", row_group_size=in_group, compression="none", use_dictionary=False)
    return folder


def shuffles(df):
    return "Exchange" in df._jdf.queryExecution().executedPlan().toString()


def test_row_groups_that_reach_all_cores_are_not_shuffled(spark, edges, tmp_path):
    apart, whole = edges(documents(tmp_path / "apart", 32, 1)), edges(documents(tmp_path / "whole", 32, 32))
    assert not shuffles(apart)  # one file, a row group in each of many splits
    assert shuffles(whole)  # many splits, rows in one of them only
    assert apart.count() > 32 and sorted(apart.collect()) == sorted(whole.collect())


def test_edges_are_stored_compactly(spark, edges, tmp_path):
    folder = documents(tmp_path / "docs", 32, 32)

    def stored(to, **options):
        edges(folder).coalesce(1).write.parquet(f"{tmp_path}/{to}", **options)
        (part,) = glob.glob(f"{tmp_path}/{to}/*.parquet")
        group = pq.ParquetFile(part).metadata.row_group(0)
        return group.column(0).compression, group.num_rows, sum(group.column(n).total_compressed_size for n in range(group.num_columns))

    codec, rows, size = stored("unset")
    assert codec == "ZSTD" and stored("named", compression="snappy")[0] == "SNAPPY"
    spark.conf.set(CODEC, "snappy")  # the owner's choice stays
    assert stored("chosen")[:2] == ("SNAPPY", rows) and size < 0.65 * stored("again")[2]
