"""The pipeline stage by stage against brute force, each on what the stage before kept."""

import re
from collections import Counter

import pytest

import corpus_pipeline
from shelfcast.llm import secrets as sec
from shelfcast.llm.toxicity import toxicity
from test_decontaminate import brute_force as benchmark_hits
from test_near_dedup import brute_force as near_groups
from test_packing import one_by_one, placed_bins
from test_secrets import RUN, base_spans, trained

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def kept(spark):
    """Rows by stage, as the pipeline writes them."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = {"input": docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.cut_lineage(stage(spark, docs, FOLDER))
        out[name] = docs.collect()
        if name != "packing":
            assert docs.dtypes == spark.read.parquet(f"{FOLDER}/documents.parquet").dtypes
    return out


def ids(rows):
    return {r.doc_id for r in rows}


def test_toxic_documents_go(spark, kept):
    scored = toxicity(spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(f"{FOLDER}/labels.parquet"))
    assert ids(kept["toxicity"]) == {r.doc_id for r in scored.collect() if not r.predicted}
    assert 0.8 * len(kept["input"]) < len(kept["toxicity"]) < len(kept["input"])


def test_one_of_each_group_stays(kept):
    groups = near_groups([(r.doc_id, r.text) for r in kept["toxicity"]], 5, 80)
    assert ids(kept["near_dedup"]) == {i for i, (_, _, first) in groups.items() if first}
    assert len(kept["near_dedup"]) == len(ids(kept["near_dedup"])) < len(kept["toxicity"])


def test_contaminated_documents_go(spark, kept):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    hits = benchmark_hits([(r.doc_id, r.text) for r in kept["near_dedup"]], items)
    assert hits and ids(kept["decontamination"]) == ids(kept["near_dedup"]) - {d for d, _ in hits}


def test_secrets_are_masked(kept):
    before = {r.doc_id: r for r in kept["decontamination"]}
    config = sec.MarkovConfig()
    ratio = trained([r.text for r in before.values()], config)
    changed = 0
    for r in kept["secret_scan"]:
        text, hidden = before[r.doc_id].text, set()
        spans = base_spans(text) + [(m.start(), 3, m.end()) for m in RUN.finditer(text) if ratio(m[0]) >= config.min_ratio]
        for start, _, end in spans:
            hidden |= set(range(start, end))
        expected = re.sub("\0+", sec.MASK, "".join("\0" if i in hidden else c for i, c in enumerate(text)))
        assert r.text == expected and r.n_chars == (len(expected) if spans else before[r.doc_id].n_chars)
        changed += bool(spans)
    assert changed and len(kept["secret_scan"]) == len(before)


def test_all_tokens_are_packed(kept):
    tokens = Counter()
    for r in kept["packing"]:
        tokens[r.doc_id] += r.tokens
    texts = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) + 1 for r in kept["secret_scan"]}
    assert tokens == Counter(texts)
    assert placed_bins(kept["packing"]) == one_by_one([r.tokens for r in kept["packing"]], corpus_pipeline.pack_documents.__defaults__[0])


def test_run_applies_the_stages_in_order(spark, monkeypatch):
    """Each stage gets what the one before has written, read again from Parquet."""
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "near_dedup", "decontamination", "secret_scan", "packing"]
    seen = []

    def stage(number):
        def step(session, docs, folder):
            seen.append((number, docs.count(), folder, "FileScan" in docs._jdf.queryExecution().executedPlan().toString()))
            return docs.where(f"doc_id % {number + 2} <> 0")
        return step

    monkeypatch.setattr(corpus_pipeline, "STAGES", [(str(i), stage(i)) for i in range(4)])
    small = "/root/testdata/sf0.001"
    ids = {r.doc_id for r in corpus_pipeline.run(spark, small).collect()}
    assert ids == {i for i in range(200) if all(i % k for k in (2, 3, 4, 5))}
    assert [x[0] for x in seen] == [0, 1, 2, 3] and all(x[2:] == (small, True) for x in seen)
    assert [x[1] for x in seen[:2]] == [200, 100]


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_odd_rows(spark, odd_docs, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    found = stage(spark, odd_docs, FOLDER)
    assert found.count() > 0
    if name != "packing":
        assert found.columns == odd_docs.columns
        expected = {0, 1, 2, 3, 4, 5, 6, 8, None} | ({7} if name != "near_dedup" else set())
        assert {r.doc_id for r in found.collect()} == expected
    assert stage(spark, odd_docs.limit(0), FOLDER).count() == 0
