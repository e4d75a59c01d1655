"""Quality scores: the SQL on odd rows, held-out accuracy, and how sites are shrunk."""

import zlib

import duckdb
import pytest

from shelfcast.llm import site_quality as sq


def test_held_out_accuracy_and_clean_documents_stay(spark):
    folder = "/root/testdata/sf0.1"
    rows = {r.doc_id: r for r in sq.op3_site_quality(spark, folder).collect()}
    labels = [(r.doc_id, r.quality) for r in spark.read.parquet(f"{folder}/labels.parquet").collect()]
    held = [(rows[i], q) for i, q in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    good = [r.keep for r, q in held if q == 1]
    bad = [r.keep for r, q in held if q == 0]
    assert sum(good) / len(good) > 0.98 and sum(bad) / len(bad) < 0.2


def test_sparse_sites_follow_the_level_above(spark):
    """A large bad host keeps its own rate; one document cannot move a host far."""
    plain, noisy = "A plain sentence of ordinary words that goes on. " * 6, "%%% ### $$$ !!! &&& *** @@@ ||| " * 8
    rows, labels = [], []
    for i in range(900):
        host = "bad" if i < 200 else "good"
        rows.append((i, noisy if host == "bad" or i % 50 == 0 else plain, host, f"p{i % 2}"))
        labels.append((i, int(rows[-1][1] is plain)))
    rows += [(1000, noisy, "tiny", "p"), (1001, plain, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    found = {r.doc_id: r for r in sq.site_quality(docs, spark.createDataFrame(labels, "doc_id long, quality int")).collect()}
    whole = sum(q for _, q in labels) / len(labels)
    assert found[0].host_rate < 0.1 and found[201].host_rate > 0.9
    assert abs(found[1000].host_rate - whole) < abs(found[0].host_rate - whole)
    assert not found[1000].keep and found[1001].keep and found[201].keep


@pytest.mark.parametrize("labelled", [True, False])
def test_odd_rows_match_the_sql(spark, odd_docs, tmp_path, labelled):
    labels = [(i, i % 2) for i in range(40)] + [(3, 1), (None, 1), (4, None), (6, 9)] if labelled else []
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = odd_docs.selectExpr("doc_id", "text", "nullif(lang, 'en') AS lang", "source")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    for name in ("documents", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    found = sorted(map(tuple, sq.op3_site_quality(spark, str(tmp_path)).collect()), key=str)
    assert found == sorted(con.execute(sq.op3_sql()).fetchall(), key=str)
    assert len(found) == odd_docs.count()


def test_empty_table_and_clashing_columns(spark, odd_docs):
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    assert sq.site_quality(odd_docs.limit(0), labels).count() == 0
    extra = odd_docs.selectExpr("*", "1 AS host", "2 AS path", "3 AS bins", "4 AS own", "5 AS total", "6 AS t")
    assert sq.site_quality(extra, labels).columns == ["doc_id", "evidence", "host_rate", "path_rate", "score", "keep"]
    assert sq.site_quality(extra, labels).count() == odd_docs.count()
