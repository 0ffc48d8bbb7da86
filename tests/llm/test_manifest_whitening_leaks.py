"""Merkle manifest, embedding whitening and benchmark decontamination against brute force."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import decontaminate, merkle, queries, whitening
from tests.llm.conftest import ODD


# ---------------------------------------------------------------- merkle


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(values):
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def plain_tree(nodes, fan):
    """Root, and per node its siblings level by level."""
    paths = [[] for _ in nodes]
    at = list(range(len(nodes)))
    while len(nodes) > 1:
        for k, i in enumerate(at):
            run = nodes[i - i % fan : i - i % fan + fan]
            paths[k].append((run[: i % fan], run[i % fan + 1 :]))
        nodes = [sha(*nodes[i : i + fan]) for i in range(0, len(nodes), fan)]
        at = [i // fan for i in at]
    return nodes[0], paths


def plain_manifest(rows, fan):
    """rows: (doc_id, source, lang, n_chars, text)."""
    trees, out = {}, []
    for r in rows:
        seen = r[4]
        if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and seen is not None:
            seen = re.sub("[A-Z]", lambda m: m[0].lower(), seen)
        trees.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, plain_leaf(r), plain_leaf((*r[:4], seen)), r[0]))
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    subs = {s: plain_tree([x[2] for x in sorted(trees[s])], fan) for s in order}
    root, tops = plain_tree([subs[s][0] for s in order], fan) if order else (None, [])
    for s, top in zip(order, tops):
        for x, path in zip(sorted(trees[s]), subs[s][1]):
            node, all_siblings = x[3], []
            for left, right in path + top:
                node = sha(*left, node, *right)
                all_siblings += left + right
            out.append((x[4], x[2], subs[s][0], root, sha(*all_siblings), node, node == root))
    return sorted(out, key=str)


def document_rows(df):
    return [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in df.collect()]


def test_merkle_query_equals_brute_force(spark, odd_documents, odd_dir):
    got = [tuple(r) for r in queries.op11_merkle_manifest(spark, odd_dir).collect()]
    assert sorted(got, key=str) == plain_manifest(document_rows(odd_documents), merkle.FAN)
    assert {r[-1] for r in got} == {True, False}


@pytest.mark.parametrize("fan,depth", [(2, 1), (3, 2), (16, 1)])
def test_merkle_over_several_rounds(spark, odd_documents, fan, depth):
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    text = F.when(tampered, F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).otherwise(F.col("text"))
    seen = [text if c == "text" else F.col(c) for c in merkle.COLUMNS]
    got = merkle.manifest(odd_documents, seen, fan=fan, depth=depth)
    got = got.select("doc_id", "leaf", "subroot", "root", merkle.proof_hash(), "folded_root", "verified").collect()
    assert sorted(map(tuple, got), key=str) == plain_manifest(document_rows(odd_documents), fan)


def test_merkle_proofs_verify_by_themselves(spark, odd_documents):
    for r in merkle.manifest(odd_documents, fan=4, depth=1).collect():
        assert r.verified and merkle.folded(r.leaf, r.lefts, r.rights) == r.root == r.folded_root


def test_merkle_of_no_and_one_row(spark, odd_documents, empty_dir):
    assert queries.op11_merkle_manifest(spark, empty_dir).collect() == []
    one = merkle.manifest(odd_documents.where("doc_id = 100004")).collect()
    assert [(r.leaf, r.lefts, r.rights) for r in one] == [(one[0].root, [], [])]
    assert one[0].subroot == one[0].leaf


def test_merkle_with_one_source_per_row_and_one_hot_source(spark):
    rows = [(i, "hot" if i % 3 else f"s{i}é", None, i, "Text") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    got = merkle.manifest(df, fan=4, depth=2).collect()
    want = {r[0]: r[2:5] for r in plain_manifest(rows, 4)}
    assert {r.doc_id: (r.subroot, r.root) for r in got} == {k: v[:2] for k, v in want.items()}


def test_merkle_oracle_sql_agrees(spark, odd_documents):
    import duckdb

    from strata.llm.oracle import MERKLE_MANIFEST

    con = duckdb.connect()
    con.register("documents", odd_documents.select(*merkle.COLUMNS).toArrow())
    got = sorted(con.sql(MERKLE_MANIFEST).fetchall(), key=str)
    assert got == plain_manifest(document_rows(odd_documents), merkle.FAN)


# ---------------------------------------------------------------- whitening


@pytest.mark.parametrize("n,seed", [(1, 0), (2, 1), (3, 2), (17, 3), (64, 4), (96, 5)])
def test_solver_equals_dense_eigenvectors(n, seed):
    rng = np.random.default_rng(seed)
    r = np.linalg.qr(rng.normal(size=(3 * n, n)) * np.exp(rng.normal(size=n) * 3), mode="r")
    a, b, v = whitening.bidiagonal(r)
    values = whitening.squared_singular_values(a, b)
    assert np.allclose(values, np.linalg.svd(r)[1] ** 2, rtol=1e-11)
    k = min(n, 4)
    vectors = v @ whitening.singular_vectors(a, b, values, k)
    assert np.allclose(vectors.T @ vectors, np.eye(k), atol=1e-12)
    assert np.abs(r.T @ (r @ vectors) - vectors * values[:k]).max() <= 1e-12 * values[0]


@pytest.mark.parametrize("spectrum", [[5.0] * 20, [3.0, 3.0 + 1e-13, 3.0 - 1e-13, 1.0, 1e-8, 0.0], [1e6, 1.0, 1e-6, 1e-9], [0.0, 2.0, 0.0, 2.0]])
def test_solver_with_equal_tiny_and_zero_values(spectrum):
    rng = np.random.default_rng(7)
    n = len(spectrum)
    q = np.linalg.qr(rng.normal(size=(n, n)))[0]
    r = np.linalg.qr(np.diag(spectrum) @ q, mode="r")
    a, b, v = whitening.bidiagonal(r)
    values = whitening.squared_singular_values(a, b)
    assert np.allclose(np.sqrt(values), sorted(spectrum, reverse=True), atol=1e-11 * max(spectrum))
    k = sum(x > 1e-7 for x in spectrum[:4])
    k = min(k, 4)
    vectors = v @ whitening.singular_vectors(a, b, values, k)
    assert np.allclose(vectors.T @ vectors, np.eye(k), atol=1e-10)
    assert np.abs(r.T @ (r @ vectors) - vectors * values[:k]).max() <= 1e-10 * values[0]


def plain_whitening(rows):
    live = [(i, [math.floor(256 * float(c)) for c in v]) for i, v in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    dims = max((len(v) for _, v in live), default=0)
    live = [(i, v + [0] * (dims - len(v))) for i, v in live]
    distinct = sorted({tuple(v) for _, v in live})
    n = len(distinct)
    sums = [sum(v[d] for v in distinct) for d in range(dims)]
    deviations = sorted((str(i), sum((n * x - s) ** 2 for x, s in zip(v, sums))) for i, v in live)
    centred = np.array(distinct, float) - np.array(sums, float) / max(n, 1)
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    return n, np.array(sums), deviations, live, values[::-1], vectors[:, ::-1]


def vector_rows(n, dims, seed):
    rng = np.random.default_rng(seed)
    rows = [(i, [float(x) for x in rng.normal(size=dims) * np.linspace(1, 4, dims)]) for i in range(n)]
    rows += [(n + i, rows[3][1]) for i in range(n)]  # half of all rows repeat one vector
    return rows + [(3 * n, None), (3 * n + 1, [None] * dims), (3 * n + 2, [float("nan")] * dims),
                   (3 * n + 3, [float("-inf")] + [0.0] * (dims - 1)), (None, rows[5][1]), (3 * n + 4, rows[6][1][:-1])]


@pytest.mark.parametrize("n,dims", [(200, 12), (30, 3), (9, 40)])
def test_whitening_query_equals_brute_force(spark, as_table, n, dims, monkeypatch):
    monkeypatch.setattr(whitening, "FAN", 2)
    rows = vector_rows(n, dims, n)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("x", F.lit("clash"))
    root = as_table(df.repartition(7), "embeddings")
    got = queries.op12_embedding_whitening(spark, root).collect()
    n_fit, sums, deviations, live, values, vectors = plain_whitening(rows)
    assert {r.n for r in got} == {n_fit}
    k = min(4, dims)
    assert len(got) == k * len(live)
    assert sorted((str(r.vec_id), r.deviation) for r in got if r.component == 1) == deviations
    by_id = {i: v for i, v in live}
    sign = {}
    for r in got:
        c = r.component - 1
        want = (np.array(by_id[r.vec_id]) - sums / n_fit) @ vectors[:, c] / math.sqrt(values[c])
        if abs(want) > 1e-3:
            s = sign.setdefault(c, math.copysign(1, want * r.whitened))
            assert abs(s * want - r.whitened) < 1e-9 * max(1, abs(want))
        assert abs(r.explained / (values[c] / values.sum()) - 1) < 1e-9
        assert 0 <= r.identity_error < 1e-9


def test_whitening_without_variance_or_rows(spark, as_table):
    schema = "vec_id long, embedding array<float>, n int"
    for rows in ([], [(1, None, 1)], [(1, [1.0, 2.0], 1), (2, [1.0, 2.0], 1)], [(1, [], 1)]):
        root = as_table(spark.createDataFrame(rows, schema), "embeddings")
        assert queries.op12_embedding_whitening(spark, root).collect() == []
    line = [(i, [float(i), 0.5, -float(i)], 1) for i in range(5)]  # rank one
    got = queries.op12_embedding_whitening(spark, as_table(spark.createDataFrame(line, schema), "embeddings")).collect()
    assert {r.component for r in got} == {1} and len(got) == 5


def test_whitening_deviation_beyond_a_long_is_null(spark, as_table):
    rows = [(i, [float(2**40 + i * 2**30), float(i % 3)]) for i in range(8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = queries.op12_embedding_whitening(spark, as_table(df, "embeddings")).collect()
    assert {r.deviation for r in got} == {None}
    vectors = whitening.integer_vectors(df, vec_id=F.col("vec_id"))
    exact = whitening.transform(vectors, whitening.fit(whitening.fit_list(vectors)), "vec_id").collect()
    assert sorted((str(r.vec_id), int(r.deviation)) for r in exact) == plain_whitening(rows)[2]


# ---------------------------------------------------------------- decontamination


def plain_words(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def plain_leaks(docs, items, window=10):
    grams = {}
    for item, text in items:
        w = plain_words(text)
        k = min(len(w), window)
        for i in range(len(w) - k + 1 if w else 0):
            grams.setdefault(tuple(w[i : i + k]), set()).add("" if item is None else str(item))
    out = []
    for doc, text in docs:
        w, hit, found = plain_words(text), set(), set()
        for k in {len(g) for g in grams}:
            for i in range(len(w) - k + 1):
                names = grams.get(tuple(w[i : i + k]))
                if names:
                    found |= names
                    hit |= set(range(i, i + k))
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def leaks(spark):
    """Documents with planted windows, whole items, borders of words, and odd texts."""
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(60)] + ["Ünïcödé", "日本", "x9"]
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, say(rng.choice([10, 11, 30, 80]))) for i in range(20)]
    items += [(3, "another text of item three"), (50, "short item"), (51, "Short-ITEM!"), (52, "lone"), (53, None),
              (54, ""), (55, "-- !"), (None, say(12)), (56, items[2][1]), (56, items[2][1])]
    docs = [(i, say(rng.randint(0, 400))) for i in range(40)]
    for i in range(40, 80):
        w = items[i % 20][1].split()
        a = rng.randint(0, max(0, len(w) - 10))
        docs.append((i, f"{say(rng.randint(0, 30))}. {', '.join(w[a : a + rng.randint(8, 14)]).upper()}; {say(5)}"))
    docs += [(100, "a short\titem b"), (101, "shorty items"), (102, "lone"), (103, "LONE lone alone"), (104, items[1][1])]
    docs += [(200 + i, t) for i, t in enumerate(ODD)] + [(None, items[4][1]), docs[45], docs[45]]
    return docs, items


def leak_dir(spark, as_table, docs, items):
    rows = [(*d, 1, "clash") for d in docs]
    root = as_table(spark.createDataFrame(rows, "doc_id long, text string, n_words int, `row` string").repartition(4), "documents")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return root


def test_decontamination_query_equals_brute_force(spark, as_table, leaks):
    got = queries.op13_decontamination(spark, leak_dir(spark, as_table, *leaks)).collect()
    want = plain_leaks(*leaks)
    assert sorted(map(tuple, got), key=str) == want
    assert sum(r[-1] for r in want) > 20


@pytest.mark.parametrize("piece,slice_bytes", [(64, 1 << 20), (1 << 20, 6000), (200, 4000)])
def test_decontamination_in_pieces_and_slices(spark, leaks, piece, slice_bytes):
    docs, items = leaks
    found = decontaminate.find(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
        spark.createDataFrame(items, "item_id long, text string"),
        F.struct("doc_id", "text"), slice_bytes=slice_bytes, piece=piece,
    ).collect()
    got = [(r.row.doc_id, r.n_words, r.n_hit, len(r["items"]), sha(",".join(r["items"])), r.n_hit > 0) for r in found]
    assert sorted(got, key=str) == plain_leaks(docs, items)
    for r in found:  # spans are the hit words, in bytes of the text
        raw = (r.row.text or "").encode()
        for s in r.spans:
            assert len(plain_words(raw[s.start : s.end].decode())) == s.last - s.first + 1
            assert len(plain_words(raw[: s.start].decode())) == s.first
        assert all(a.last + 1 < b.first for a, b in zip(r.spans, r.spans[1:]))


def test_decontaminate_cuts_spans_or_drops_documents(spark, leaks):
    docs, items = leaks
    df = spark.createDataFrame([(*d, "clash") for d in docs], "doc_id long, text string, spans string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    clean = {r[0] for r in plain_leaks(docs, items) if not r[-1]}
    dropped = decontaminate.decontaminate(df, bench, "documents")
    assert dropped.columns == df.columns
    assert {r.doc_id for r in dropped.collect()} == clean
    cut = decontaminate.decontaminate(df, bench)
    assert cut.schema == df.schema and cut.count() == len(docs)
    before, after = dict(docs), {r.doc_id: r.text for r in cut.collect()}
    assert {d: after[d] for d in clean} == {d: before[d] for d in clean}
    hits = {r[0]: (r[1], r[2]) for r in plain_leaks(docs, items)}
    for d, text in after.items():
        # pieces beside a cut never merge into one word: what was between them stays
        assert len(plain_words(text)) == hits[d][0] - hits[d][1]


def test_decontamination_of_no_documents_or_no_benchmark(spark, as_table, leaks):
    assert queries.op13_decontamination(spark, leak_dir(spark, as_table, leaks[0][:0], leaks[1])).collect() == []
    got = queries.op13_decontamination(spark, leak_dir(spark, as_table, leaks[0], leaks[1][:0])).collect()
    assert sorted(map(tuple, got), key=str) == plain_leaks(leaks[0], [])


def test_decontamination_of_a_very_long_text(spark):
    text = "filler words here " * 400_000 + "the quick brown fox jumps over the lazy dog today " + "more " * 200_000
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    bench = spark.createDataFrame([(7, "The quick brown fox jumps over the lazy dog today again")], "item_id long, text string")
    r = decontaminate.find(docs, bench, F.col("doc_id")).first()
    assert (r.n_words, r.n_hit, r["items"]) == (1_400_010, 10, ["7"])
    assert text.encode()[r.spans[0].start : r.spans[0].end].decode() == text[7_200_000:7_200_049]
