import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import corpus  # noqa: E402
import corpus_pipeline  # noqa: E402
from touchline.llm import catalog, mixing  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture()
def tables(spark, folder):
    rows = [row for row in corpus.ROWS if row[0] not in (3, 12)] + [(20 + i, f"{corpus.BASE} more{i} " + " ".join(f"m{i}n{k}" for k in range(90)), "en", "a") for i in range(6)]
    frame = spark.createDataFrame([(*row, None) for row in rows], "doc_id long, text string, lang string, source string, n_chars long")
    frame.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder, rows


def test_stages_against_brute_force(spark, tables):
    folder, rows = tables
    by_id = {row[0]: row for row in rows}
    got = corpus_pipeline.run(spark, folder)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "token_ids"]

    def passes(text):
        w = corpus.words(text)
        windows = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
        twice = {i for i, x in enumerate(windows) if windows.count(x) > 1} if len(w) < 1000 else set()
        covered = {k for i in twice for k in range(i, i + 8)}
        return len(w) >= 20 and 100 * len(covered) <= 30 * len(w)

    kept = [row for row in rows if passes(row[1])]
    first = {}
    for row in sorted(kept, key=lambda r: (r[0] is None, r[0] or 0)):
        first.setdefault(corpus.spaced(row[1]), row)
    groups = {i: c for i, _, c in corpus.near_components(list(first.values()))}
    stays = {row[0]: row for row in first.values() if groups[row[0]] == row[0]}
    total = {}
    for row in got.collect():
        assert row["text"] == by_id[row["doc_id"]][1] and row["token_ids"]
        total[row["doc_id"]] = total.get(row["doc_id"], 0) + 1
    copies = {r["doc_id"]: r["copies"] for r in mixing.mixed(spark.createDataFrame(list(stays.values()), "doc_id long, text string, lang string, source string")).collect()}
    assert total == {k: v for k, v in copies.items() if v}


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")
def test_every_operator_is_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in catalog.all_queries())
    assert numbers == list(range(1, 11)) and set(catalog.all_oracles()) <= set(catalog.all_queries())


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")
def test_queries_equal_their_sql(spark):
    import check

    assert check.compare(spark, SMALL, sorted(catalog.all_oracles())) == []
