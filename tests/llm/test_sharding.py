"""The shuffle is a permutation with an inverse, and shards are even and gapless."""

import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from shelfcast.llm.sharding import Shuffle, assign_shards, op7_sharding, op7_sql


@pytest.mark.parametrize("n", [1, 2, 3, 23, 24, 25, 1000, 4096, 4097, 70_001])
def test_permutation_and_inverse(n):
    shuffle = Shuffle(n, 24)
    rows = np.arange(n)
    places = shuffle.permuted(rows)
    assert (np.sort(places) == rows).all()
    assert (shuffle.original(places) == rows).all()
    shard, slot = shuffle.locate(rows)
    assert (shuffle.row_at(shard, slot) == rows).all()
    counts = np.bincount(shard, minlength=24)
    assert counts.max() - counts.min() <= 1


def test_large_numbers_stay_in_range():
    shuffle = Shuffle(10**13 + 7, 24, seed=11)
    rows = np.array([0, 1, 10**12, 10**13 + 6])
    assert (shuffle.original(shuffle.permuted(rows)) == rows).all()


def test_order_is_mixed_and_depends_on_the_seed():
    rows = np.arange(50_000)
    one, other = Shuffle(50_000, 24).permuted(rows), Shuffle(50_000, 24, seed=8).permuted(rows)
    assert abs(np.corrcoef(rows, one)[0, 1]) < 0.02
    assert (one == other).sum() < 20


def test_registered_query(spark):
    folder = "/root/testdata/sf0.01"
    rows = op7_sharding(spark, folder).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    slots = {}
    for r in rows:
        data = texts[r.doc_id].encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(data) + 8, zlib.crc32(data), "rows", None)
        slots.setdefault(r.shard, []).append(r.slot)
    assert set(slots) == set(range(24))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_odd_rows(spark, odd_docs, tmp_path):
    odd_docs.select("doc_id", "text").write.parquet(str(tmp_path / "documents.parquet"))
    rows = [tuple(r) for r in op7_sharding(spark, str(tmp_path)).collect()]
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    by_text = lambda r: str(r)
    assert sorted(rows, key=by_text) == sorted(con.execute(op7_sql()).fetchall(), key=by_text)
    placed = assign_shards(odd_docs, 5).collect()
    assert Counter(Counter(r.shard for r in placed).values()) == Counter({2: 4, 3: 1})
    assert next(r["size"] for r in placed if r.doc_id == 0) == 8
    assert assign_shards(odd_docs.limit(0), 5).count() == 0
