import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as contract  # noqa: E402
import check  # noqa: E402
from touchline.catalog import feeds, oracles, tables  # noqa: E402
from touchline.catalog import queries as catalog  # noqa: E402

SMALL = "/root/testdata/sf0.001"
NAMES = ["raw_from_json", "bronze_positions", "silver_positions", "gold_possessions", "gold_possessions_stream", "goalkeepers"]


def test_every_query_has_an_oracle():
    assert set(oracles.all_oracles()) == set(catalog.all_queries())
    assert set(catalog.all_queries()) <= set(contract.queries())


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")
def test_queries_equal_their_oracles(spark):
    assert check.compare(spark, SMALL, NAMES) == []


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")
def test_entry(spark):
    assert contract.entry(spark).count() == 61


def test_documents_are_files_of_one_folder_written_by_all_tasks(spark, tmp_path):
    rows = spark.range(50).selectExpr("id AS supplier", "concat('line 1\n', id) AS value").coalesce(1)
    path = feeds._one_file_each(rows, str(tmp_path / "documents"))
    assert not [p for p in (tmp_path / "documents").iterdir() if p.is_dir()]
    files = spark.read.text(path, wholetext=True).selectExpr("value", "_metadata.file_name AS file").collect()
    assert sorted(r.value.strip() for r in files) == sorted(f"line 1\n{n}" for n in range(50))
    assert len({r.file for r in files}) == 50 and len({r.file[:10] for r in files}) > 1


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")
@pytest.mark.parametrize("name", ["attack_direction", "raw_from_json", "raw_explode_project", "unknown_match_modes"])
def test_rows_read_once_are_not_stored(spark, monkeypatch, name):
    monkeypatch.setattr(tables, "_STORED", {})
    direct = sorted(map(repr, catalog.all_queries()[name](spark, SMALL).collect()))
    assert tables._STORED == {}
    tables.raw_table(spark, SMALL)
    assert sorted(map(repr, catalog.all_queries()[name](spark, SMALL).collect())) == direct
