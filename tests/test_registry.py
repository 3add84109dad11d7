"""Driver contract at sf0.001: entry smoke, registry completeness, and a
few Spark-vs-DuckDB comparisons (the full set runs in tools/compare.py)."""

import os

import pytest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="fixtures not present")


def test_registry_complete():
    import __spark_entry__ as ent
    from sparkngram.plans import registry
    assert set(registry.QUERIES) == set(registry.SQL)
    assert set(registry.QUERIES) <= set(ent.queries()) and set(ent.oracle_sql()) <= set(ent.queries())
    assert len(registry.QUERIES) >= 60


def test_entry_smoke(spark):
    import __spark_entry__ as ent
    df = ent.entry(spark)
    rows = df.collect()
    assert len(rows) == 2
    assert df.columns == ["list_name", "line_count", "word_count", "score", "max_score", "hit_count_top3",
                          "hit_count_top1", "total_count"]
    for r in rows:
        assert 0 <= r.score <= r.max_score and r.hit_count_top1 <= r.hit_count_top3 <= r.total_count


@pytest.mark.parametrize("name", ["eval_dataset", "sbo_top5", "freq_of_freq", "kn_bigram", "sample_lines", "collocations",
                                  "predict_top5", "predict_top5_unigram", "predict_katz_top5", "heldout_fingerprint",
                                  "matching_lines", "unk_tokens", "interp"])
def test_against_duckdb(spark, name):
    duckdb = pytest.importorskip("duckdb")
    import __spark_entry__ as ent
    from tools.compare import TABLES, digest
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{p}'")
    df = ent.queries()[name](spark, SF)
    rows, cols = [tuple(r) for r in df.collect()], df.columns
    cur = con.execute(ent.oracle_sql()[name])
    drows, dcols = cur.fetchall(), [d[0] for d in cur.description]
    assert sorted(cols) == sorted(dcols)
    assert len(rows) == len(drows)
    assert digest(rows, cols) == digest(drows, dcols)
