"""The pipeline, stage by stage, against brute force."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from strata.llm import packing, quality_rules
from strata.llm.common import stored
from tests.llm import brute

corpus_pipeline = pytest.importorskip("corpus_pipeline")


def keyed(rows):
    return Counter((r.doc_id, r.text) for r in rows)


def test_stages(spark, odd_documents):
    docs, columns = odd_documents, odd_documents.columns
    rows = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, None), "stage")
        rows[name] = docs.collect()
        if name != "packing":
            assert docs.columns == columns
    raw = odd_documents.collect()

    kept = quality_rules.verdict(quality_rules.measure(odd_documents, keep=("doc_id", "text"))).where("kept").collect()
    assert keyed(rows["quality rules"]) == keyed(kept)

    found = brute.simhash([(r.doc_id, r.text) for r in rows["quality rules"]])
    assert sorted(r.doc_id for r in rows["near duplicates"]) == sorted({c for _, _, c in found})

    before = {r.doc_id: r for r in rows["near duplicates"]}
    assert len(rows["personal data"]) == len(before)
    for r in rows["personal data"]:
        counts, spans = brute.pii(r.text)
        assert not spans
        if not brute.pii(before[r.doc_id].text)[1] and "token" not in before[r.doc_id].text:
            assert r.text == before[r.doc_id].text
        assert r.n_chars == len(r.text)

    clean = {r.doc_id: r for r in rows["personal data"]}
    copies = Counter(r.doc_id for r in rows["source mixing"])
    assert set(copies) <= set(clean) and max(copies.values()) <= 2
    sizes, taken = defaultdict(int), defaultdict(int)
    for d, r in clean.items():
        sizes[r.source] += len(brute.words(r.text))
        taken[r.source] += copies[d] * len(brute.words(r.text))
    longest = {s: max(len(brute.words(r.text)) for r in clean.values() if r.source == s) for s in sizes}
    for s, want in brute.targets(sizes).items():
        assert abs(taken[s] - want) <= longest[s] / 2

    whole = packing.encoder().whole
    for r in rows["packing"]:
        ids = np.array([*whole.encode(clean[r.doc_id].text, add_special_tokens=False).ids, 0], "<u4")
        assert len(ids) == r.doc_tokens
        assert zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32
    total = sum(r.length for r in rows["packing"])
    assert total == sum(copies[d] * (len(whole.encode(r.text).ids) + 1) for d, r in clean.items())
    assert len({r.sequence_id for r in rows["packing"]}) == -(-total // 1024)
    assert len(raw) > len(rows["quality rules"])


def test_run_is_the_registered_query(spark, odd_dir, empty_dir):
    from __spark_entry__ import queries

    assert queries()["pipeline"] is corpus_pipeline.run
    out = corpus_pipeline.run(spark, odd_dir)
    assert out.count() > 0 and out.columns[0] == "doc_id"
    assert corpus_pipeline.run(spark, empty_dir).count() == 0
