"""The driver's entry points: names, SQL, and results against DuckDB on the smallest tables."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.001"
ROOT = Path(entry.__file__).resolve().parent
SOME = ["flagship", "a10_grouping_sets", "a17_entity_index", "a26_path_inventory", "j1_chain_join", "j5_relation_closure", "j9_assembly_run_link", "k1_partitioned_write", "p10_external_ids", "t6_largest_dirs", "u3_multiset_compare", "v7_backcheck_fields", "w2_manifest_row_id", "i1_incremental_ingest", "s2_tsv_shape_check", "s5_file_listing", "t8_prefix_stratified", "v12_thresholds", "f6_entity_lookup"]


def plain(value):
    return round(float(value), 6) if isinstance(value, float) else value


@pytest.mark.parametrize("name", SOME)
def test_equals_sql(spark, name):
    if not os.path.isdir(DATA):
        pytest.skip("no tables")
    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.sql(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{DATA}/{f}'")
    want = con.sql(entry.oracle_sql()[name])
    got = entry.queries()[name](spark, DATA)
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    rows = sorted((tuple(plain(r[c]) for c in columns) for r in got.collect()), key=str)
    assert rows == sorted((tuple(map(plain, r)) for r in want.select(*columns).fetchall()), key=str)


def test_every_sql_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_without_the_corpus_operators(tmp_path):
    """The rest imports and registers its queries where the corpus operators are taken out."""
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    shutil.copytree(ROOT / "tidemark", tmp_path / "tidemark", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); assert 'flagship' in q and not any(n.startswith('op') for n in q), list(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env=os.environ | {"PYTHONPATH": str(tmp_path)})
