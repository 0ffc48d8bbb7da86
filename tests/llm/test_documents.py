"""Every operator over documents against brute force, on driver rows and odd ones."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import language_id, lm_scoring, mixing, packing, pii, quality_rules, queries, simhash, suffix_dedup
from tests.llm import brute


def rows_of(df):
    return [tuple(r) for r in df.collect()]


@pytest.fixture(scope="module")
def docs(odd_documents):
    return [(r.doc_id, r.text, r.lang, r.source) for r in odd_documents.collect()]


def pairs(docs):
    return [(d, t) for d, t, *_ in docs]


def quality_counts(text):
    toks = brute.words(text)
    lines = [x for x in (text or "").split("\n") if brute.words(x)]
    grams = Counter(tuple(toks[i : i + 8]) for i in range(len(toks) - 7))
    covered = {i + k for i in range(len(toks) - 7) if grams[tuple(toks[i : i + 8])] > 1 for k in range(8)}
    failed = len(toks) < 20 or 100 * len(covered) > 30 * len(toks)
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(toks), sum(map(len, toks)), symbols, len(lines) - len(set(lines)), len(covered), failed


def test_quality_rules(spark, docs, odd_dir):
    got = rows_of(queries.op1_quality_rules(spark, odd_dir))
    want = [(d, *quality_counts(t)) for d, t in pairs(docs)]
    key = lambda r: str(r)
    assert sorted((r[:-1] for r in got), key=key) == sorted(want, key=key)
    assert not any(r[6] and r[7] for r in got)


def test_quality_filter_keeps_rows_and_columns(odd_documents):
    kept = quality_rules.filter_documents(odd_documents)
    assert kept.columns == odd_documents.columns
    verdicts = quality_rules.verdict(quality_rules.measure(odd_documents)).where("kept")
    assert kept.count() == verdicts.count() > 0
    assert kept.where("text is null or _row <> 'clash'").count() == 0


def test_quality_rules_keep_clean_and_reject_junk(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    judged = quality_rules.verdict(quality_rules.measure(d)).join(labels, "doc_id").where("not base_failed")
    assert judged.where("quality = 1 and not kept").count() == 0
    assert judged.where("quality = 0 and kept").count() <= 0.1 * judged.where("quality = 0").count()


def test_simhash(spark, docs, odd_dir):
    got = rows_of(queries.op2_simhash_near_dedup(spark, odd_dir))
    assert sorted(got, key=str) == sorted(brute.simhash(pairs(docs)), key=str)


def test_simhash_hot_cells_lose_no_link(odd_documents, docs):
    found = simhash.near_duplicates(odd_documents, cell=4)
    got = rows_of(found.select("id", simhash.hex64(F.col("fp")), "component_id"))
    assert sorted(got, key=str) == sorted(brute.simhash(pairs(docs)), key=str)


@pytest.mark.parametrize("agree", [1, 2, 3, 4])
def test_simhash_wider_cells_lose_no_link(spark, agree):
    rng = np.random.default_rng(agree)
    base = [int(x) for x in rng.integers(0, 1 << 63, 12)]
    near = {f ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(1, 6), replace=False)) for f in base for _ in range(10)}
    fps = sorted(set(base) | near)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    distinct = spark.createDataFrame([(f,) for f in signed], "fp long")
    got = simhash.components(simhash.forest_links(distinct, cell=8, agree=agree))
    label = {f: f for f in signed}
    label.update({r.node: r.root for r in got.collect()})
    want = simhash.components(
        spark.createDataFrame(
            [(a, b) for i, a in enumerate(signed) for b in signed[:i] if bin((a ^ b) & (1 << 64) - 1).count("1") <= 4],
            "a long, b long",
        )
    )
    expected = {f: f for f in signed}
    expected.update({r.node: r.root for r in want.collect()})
    assert label == expected


def test_simhash_one_hot_fingerprint_and_one_hot_component(spark):
    far = " ".join(f"w{i}" for i in range(60))
    rows = [(i, "the same four words again and again") for i in range(6000)]
    rows += [(10_000 + i, far + f" end{i}") for i in range(300)] + [(20_000 + i, None) for i in range(50)]
    found = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    got = rows_of(found.select("id", simhash.hex64(F.col("fp")), "component_id"))
    assert sorted(got, key=str) == sorted(brute.simhash(rows), key=str)


def test_simhash_keeps_one_row_of_each_component(odd_documents, docs):
    kept = simhash.keep_one(odd_documents)
    assert kept.columns == odd_documents.columns
    ids = sorted(r.doc_id for r in kept.select("doc_id").collect())
    assert ids == sorted({c for _, _, c in brute.simhash(pairs(docs))})


def test_components_of_long_chains(spark):
    n = 300
    chain = spark.range(n - 1).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    rng = np.random.default_rng(1)
    name = rng.permutation(n).tolist()
    mixed = spark.createDataFrame([(name[i], name[i + 1]) for i in range(n - 1)] + [(1000, 1001), (5, 5)], "a long, b long")
    for links in (chain, mixed):
        roots = {r.node: r.root for r in simhash.components(links).collect()}
        assert {roots[i] for i in range(n)} == {0}
    assert roots[1001] == 1000


@pytest.mark.parametrize("hot", [suffix_dedup.HOT, 2])
def test_suffix_dedup(odd_documents, docs, hot):
    got = rows_of(suffix_dedup.remove_repeats(odd_documents, hot=hot).drop("kept"))
    want = [(d, *s) for (d, _), s in zip(pairs(docs), brute.strip([t for _, t in pairs(docs)]))]
    assert sorted(got, key=str) == sorted(want, key=str)


@pytest.mark.parametrize("length,gram", [(20, 8), (12, 12), (30, 1)])
def test_suffix_dedup_of_repetitive_texts(spark, length, gram):
    rng = np.random.default_rng(length)
    texts = ["".join(rng.choice(list("ab"), size=int(n))) for n in rng.integers(0, 80, 60)] + ["a" * 100, "ab" * 60]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r[0]: tuple(r)[1:5] for r in suffix_dedup.remove_repeats(df, length=length, gram=gram).collect()}
    assert [got[i] for i in range(len(texts))] == brute.strip(texts, length)


def test_suffix_dedup_query_drops_the_bytes(spark, odd_dir):
    assert queries.op3_suffix_dedup(spark, odd_dir).columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]


def test_packing(spark, docs, odd_dir):
    got = queries.op4_packing(spark, odd_dir).collect()
    whole = packing.encoder().whole
    ids_of = {}
    for d, t in pairs(docs):
        ids = [*whole.encode(t or "", add_special_tokens=False).ids, 0]
        ids_of.setdefault((d, len(ids)), []).append(np.array(ids, "<u4"))
    pieces = Counter()
    for r in got:
        options = ids_of[r.doc_id, r.doc_tokens]
        assert any(zlib.crc32(x[r.start : r.start + r.length].tobytes()) == r.ids_crc32 for x in options)
        pieces[r.doc_id, r.doc_tokens] += r.length
    assert pieces == {k: k[1] * len(v) for k, v in ids_of.items()}
    by_sequence = defaultdict(list)
    for r in got:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    ends = []
    for placed in by_sequence.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at and length > 0
            at += length
        ends.append(at)
    assert all(e <= 1024 for e in ends) and sum(e < 1024 for e in ends) <= 1


def test_packing_puts_copies_next_to_each_other(spark):
    texts = [f"topic {i % 5} " + "alpha beta gamma delta ".replace("a", "aeiou"[i % 5]) * 30 for i in range(50)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    order = [r.doc_id for r in packing.pack(df).where("start = 0").orderBy("sequence_id", "offset").collect()]
    changes = sum(a % 5 != b % 5 for a, b in zip(order, order[1:]))
    assert changes == 4


def test_language_id(spark, docs, odd_dir):
    got = queries.op5_language_id(spark, odd_dir).collect()
    assert len(got) == len(docs)
    for r in got:
        assert r.held_out == (zlib.crc32(str("" if r.doc_id is None else r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.lang_pred in {"en", "de", "fr", "es", "und"}
    lettered = {d: any(map(str.isalpha, t or "")) for d, t in pairs(docs) if d is not None}
    assert all((r.lang_pred == "und") == (not lettered[r.doc_id]) for r in got if r.doc_id is not None)


def test_language_id_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.op5_language_id(spark, sf).where("held_out").join(spark.read.parquet(f"{sf}/documents.parquet"), "doc_id")
    assert got.where("lang_pred = lang").count() >= 0.97 * got.count() > 100


def plain_language(docs, longest=5):
    """Word and n-gram log frequencies of labelled texts, and the judgement of any text by them."""
    learned = [(t, lang) for d, t, lang, *_ in docs
               if t is not None and lang is not None and zlib.crc32(str("" if d is None else d).encode()) % 5]
    langs = sorted({lang for _, lang in learned})
    tables = {n: {lang: Counter() for lang in langs} for n in range(longest + 1)}
    split = lambda t: re.findall(r"[^\W\d_]+", t.lower())
    pieces = lambda w, n: [f"_{w}_"[i : i + n] for i in range(len(w) + 3 - n)]
    for t, lang in learned:
        for w in split(t):
            tables[0][lang][w] += 1
            for n in range(1, longest + 1):
                tables[n][lang].update(pieces(w, n))
    seen = {n: set().union(*[set(c) for c in t.values()]) for n, t in tables.items()}

    def log(n, token, lang):
        c = tables[n][lang]
        return math.log((c[token] + 0.5) / (sum(c.values()) + 0.5 * len(seen[n])))

    def judge(text):
        if text is None or not any(map(str.isalpha, text)):
            return "und", 0.0
        total = {lang: math.log(sum(x == lang for _, x in learned) / len(learned)) for lang in langs}
        toks = split(text)
        for w in toks:
            for n, parts in [(0, [w])] + [(n, pieces(w, n)) for n in range(longest, 0, -1)]:
                known = [p for p in parts if p in seen[n]]
                if known:
                    for lang in langs:
                        total[lang] += sum(log(n, p, lang) for p in known) / len(known)
                    break
        best = max(langs, key=lambda x: (total[x], -langs.index(x)))
        shares = {x: math.exp((total[x] - total[best]) / max(1, len(toks)) ** 0.5) for x in langs}
        return best, shares[best] / sum(shares.values())

    return judge


def test_language_id_equals_brute_force(spark, docs, odd_dir):
    judge = plain_language(docs)
    want = sorted((str(d), *judge(t)) for d, t in pairs(docs))
    got = sorted((str(r.doc_id), r.lang_pred, r.score) for r in queries.op5_language_id(spark, odd_dir).collect())
    assert [r[:2] for r in got] == [r[:2] for r in want]
    assert all(abs(a[2] - b[2]) < 1e-6 for a, b in zip(got, want))


def test_language_id_backs_off_to_shorter_grams():
    words = {"the": 0}
    table = np.array([[-1.0, -5.0]])
    grams = {"der": 0, "z": 1}
    gram_table = np.array([[-9.0, -1.0], [-1.0, -9.0]])
    m = language_id.Model(["en", "xx"], np.log([0.5, 0.5]), words, grams, table, gram_table)
    assert m.predict("the")[0] == "en" and m.predict("wieder")[0] == "xx" and m.predict("zq")[0] == "en"
    assert m.predict("123 !") == ("und", 0.0)


def test_personal_data_base(spark, docs, odd_dir):
    got = queries.op6_personal_data(spark, odd_dir).collect()
    want = Counter()
    for d, t in pairs(docs):
        counts, spans = brute.pii(t)
        want[d, *counts, hashlib.sha256(",".join(spans).encode()).hexdigest()] += 1
    assert Counter(tuple(r)[:6] for r in got) == want
    texts = dict(pairs(docs))
    for r in got:
        if r.doc_id is None:
            continue
        listed = [s.split(":") for s in r.spans.split(",") if s]
        assert set(brute.pii(texts[r.doc_id])[1]) <= {":".join(s) for s in listed}
        assert [int(s[1]) for s in listed] == sorted(int(s[1]) for s in listed)
    secret = [r for r in got if r.doc_id == 100_015]
    assert secret[0].spans == "secret:9:49"


@pytest.mark.parametrize(
    "text",
    ["a@b.c.@d.e x@y", "x@y.z@a.b.c", "..a@b..c a@b.c..d", "+1 2 3 4 5 6 7 8 9 0 1-", "+12345678901 +1", "1.1.1.1.1.1.1.1.1",
     "01.002.0003.255 1.2.3.256 1.2.3.00000255", "4111111111111111 411111111111111", "4-1-1-1 1111 1111 1111 1", "12 34--56 7",
     "1234567890123456789012345", "a" * 500 + "@" + "b" * 500 + ".c", "٣.٣.٣.٣ é@é.é x+y%z@q-r.s-t", "+1()..--  9 0000000 11"],
)
def test_personal_data_patterns_equal_the_plain_ones(spark, text):
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    model = pii.estimate({("secret", 15): 5, ("secret", 8): 50})
    row = pii.annotate(df, model, [F.col("doc_id")]).select(pii.listing(F.col("_base"))).first()
    assert row[0] == ",".join(brute.pii(text)[1])


def test_personal_data_learns_who_to_trust():
    counts = {("secret", 0b1111): 300, ("secret", 0b1110): 40, ("secret", 0b1000): 500, ("secret", 0b0100): 900}
    m = pii.estimate(counts)
    assert m.score("secret", 0b1111) > 0 > m.score("secret", 0b0100)
    assert all(hit >= false for hit, false in m.reliability)


def voting(votes):
    return bin(votes).count("1") >= 3


def span_code(length, share, cases):
    return length + 4 * share + 16 * cases


def test_personal_data_training_overturns_voting_both_ways():
    # keys of one shape: few digits vote against it, but they look like the many that all labelers know
    key, words, hexes = span_code(0, 1, 2), span_code(0, 0, 1), span_code(2, 2, 1)
    counts = {("secret", 0b0100, words): 200, ("secret", 0b1101, key): 300, ("secret", 0b0101, key): 16, ("secret", 0b0101, words): 20,
              ("secret", 0b1110, span_code(1, 2, 1)): 400, ("secret", 0b1111, hexes): 370}
    m = pii.estimate(counts)
    assert m.score("secret", 0b0101, key) > 0 and not voting(0b0101)
    assert m.score("secret", 0b0101, words) < 0
    # three labelers that vote on everything say nothing; the strict one tells the spans apart
    counts = {("secret", 0b1110, words): 900, ("secret", 0b0110, words): 800, ("secret", 0b0101, hexes): 300, ("secret", 0b1111, hexes): 100}
    m = pii.estimate(counts)
    assert m.score("secret", 0b1110, words) < 0 and voting(0b1110)
    assert m.score("secret", 0b0101, hexes) > 0 and not voting(0b0101)
    # what one kind teaches leaves the others alone
    assert m.weights["iban"] == pii.estimate({}).weights["iban"] and m.rates["iban"] != m.rates["secret"]


def test_personal_data_score_column_equals_score(spark):
    m = pii.estimate({("secret", v, c): 1 + (v * c) % 7 for v in range(16) for c in range(0, 64, 5)})
    rows = [(v, c) for v in range(16) for c in range(64)]
    df = spark.createDataFrame(rows, "v int, c int")
    for r in df.select("v", "c", m.score_column("secret", F.col("v"), F.col("c")).alias("x")).collect():
        assert abs(r.x - m.score("secret", r.v, r.c)) < 1e-9


def test_personal_data_features(spark):
    texts = ["a" * 20, "A1" * 12, "0" * 40, "aB" * 24, "a" * 31 + "1"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(pii._features(F.col("t"))).collect()]
    assert got == [span_code(0, 0, 1), span_code(1, 2, 2), span_code(2, 3, 0), span_code(3, 0, 3), span_code(2, 1, 1)]


def test_personal_data_redaction(odd_documents):
    out = pii.redact_documents(odd_documents)
    assert out.columns == odd_documents.columns and out.count() == odd_documents.count()
    row = out.where("doc_id = 100010").first()
    assert row.text == "mail <EMAIL> and <IP> or <PHONE> now" and row.n_chars == len(row.text)
    assert out.where("doc_id = 100000 and text is null and n_chars is null").count() == 1
    assert out.where("doc_id = 100015").first().text == 'token = "<SECRET>" end'


def test_source_mixing(spark, docs, odd_dir):
    got = queries.op7_source_mixing(spark, odd_dir).collect()
    again = queries.op7_source_mixing(spark, odd_dir).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    sizes, source = defaultdict(int), {}
    for d, t, _, s in docs:
        sizes[s] += len(brute.words(t))
        source[d, len(brute.words(t))] = s
    want = brute.targets(sizes)
    taken = defaultdict(int)
    assert Counter((r.doc_id, r.size) for r in got) == Counter((d, len(brute.words(t))) for d, t, *_ in docs)
    for r in got:
        assert 0 <= r.taken <= 2 * r.size and (r.size == 0 or r.taken % r.size == 0)
        if r.doc_id is not None:
            s = source[r.doc_id, r.size]
            assert r.source_size == sizes[s] and math.isclose(r.target, want[s], rel_tol=1e-9)
            taken[s] += r.taken
    for s, t in taken.items():
        if s not in (None, "src2"):  # rows of a null id belong there
            longest = max(r.size for r in got if r.doc_id is not None and source[r.doc_id, r.size] == s)
            assert abs(t - want[s]) <= longest / 2  # whole copies of few documents


def test_mixing_meets_targets_of_real_sources(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.op7_source_mixing(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet"), "doc_id")
    for r in got.groupBy("source").agg(F.sum("taken").alias("t"), F.max("target").alias("want")).collect():
        assert abs(r.t - r.want) <= 0.005 * r.want


def test_mixing_rates_solve_the_dual():
    rng = np.random.default_rng(0)
    for target in (0.05, 0.5, 1.0, 1.5, 1.99, 2.0):
        size = np.unique(rng.integers(1, 5000, 300)).astype(float)
        n = rng.integers(1, 50, len(size)).astype(float)
        total = (size * n).sum()
        rate = mixing.solve_dual(size, n, target * total)
        assert abs((rate * size * n).sum() / total - target) < 1e-9 and rate.max() <= 2
        copies = mixing.settle_copies(size, n, rate)
        assert abs((copies * size).sum() - target * total) <= size.max() and (copies <= 2 * n).all()


def test_mixing_takes_rows_as_they_are(odd_documents):
    out = mixing.apply_mix(odd_documents)
    assert out.columns == odd_documents.columns
    assert out.where("_row <> 'clash' or size <> 'clash'").count() == 0
    n = out.groupBy("doc_id").count().agg(F.max("count")).first()[0]
    assert n <= 6  # at most two copies of a row that stands three times


def test_lm_base_scores(spark, docs, odd_dir):
    got = queries.op8_lm_scoring(spark, odd_dir).collect()
    want = Counter((d, *r[:4], round(r[4], 6)) for (d, _), r in zip(pairs(docs), brute.base_scores(pairs(docs))))
    assert Counter((*tuple(r)[:5], round(r.base_score, 6)) for r in got) == want
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)


def test_lm_rare_words_meet_their_counts_in_the_join(spark, odd_documents, docs, monkeypatch):
    monkeypatch.setattr(lm_scoring, "_common", lambda words, most=20: (lambda k: k)(COMMON(words, most)))
    from strata.llm.common import id_remainder

    got = lm_scoring.score(odd_documents, id_remainder(F.col("doc_id"), 7) != 2).collect()
    want = Counter((d, *r[1:4], round(r[4], 6)) for (d, _), r in zip(pairs(docs), brute.base_scores(pairs(docs))))
    assert Counter((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want


COMMON = lm_scoring._common


def test_lm_probabilities_sum_to_one_and_beat_the_base(spark):
    sf = "/root/testdata/sf0.1"
    d = spark.read.parquet(f"{sf}/documents.parquet").where("doc_id < 3000")
    from strata.llm.common import id_remainder

    got = lm_scoring.score(d, id_remainder(F.col("doc_id"), 7) != 2).join(d, "doc_id")
    held = got.where(id_remainder(F.col("doc_id"), 7) == 2).agg(F.sum("score"), F.sum("n_bytes"), F.sum("base_score")).first()
    assert -held[0] / math.log10(2) / held[1] < 2.6  # bits a byte
    tree = lm_scoring.build_tree(np.ones((256, 256)))
    m = lm_scoring.Model(tree, [np.zeros(n * lm_scoring.SYMBOLS, np.int8) for n in tree.slots])
    # knows nothing: every code costs its length, and the codes after one byte share a unit of probability
    costs = [m.bits([b"!" + bytes([b])])[0] - m.bits([b"!"])[0] for b in range(33, 127) if not 65 <= b <= 90]
    assert sum(2.0**-c for c in costs) <= 1 + 1e-6


def test_lm_contexts_are_kept_apart_however_many(spark):
    rng = np.random.default_rng(5)
    letters = rng.integers(97, 123, (40, 10_000, 5), dtype=np.uint8)
    texts = [" ".join(bytes(w).decode() for w in doc) for doc in letters]  # about 2,000,000 word pairs and prefixes
    again = [t[6 * 1000 : 6 * 1300] for t in texts]
    d = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, *again])], "doc_id long, text string")
    got = lm_scoring.score(d, F.col("doc_id") < 40).where("doc_id >= 40").agg(F.sum("score"), F.sum("n_bytes")).first()
    assert -got[0] / math.log10(2) / got[1] < 1.5  # every pair was seen, so the rest of a word follows


def test_lm_without_training_documents_costs_a_bit_each(spark):
    d = spark.createDataFrame([(1, "some text"), (2, None)], "doc_id long, text string")
    tree = lm_scoring.build_tree(np.zeros((256, 256)))
    for r in lm_scoring.score(d, F.lit(False)).collect():
        line = b"\nsome text\n" if r.doc_id == 1 else b"\n\n"
        assert abs(r.bits_per_byte * r.n_bytes - sum(tree.length[a, b] for a, b in zip(line, line[1:]))) < 1e-6


@pytest.mark.parametrize("name", [n for n in queries.REGISTRY if not re.match("op(9|10)_", n)])
def test_empty_table(spark, empty_dir, name):
    assert queries.REGISTRY[name](spark, empty_dir).collect() == []


def test_stages_on_an_empty_table(no_documents):
    for stage in (quality_rules.filter_documents, simhash.keep_one, pii.redact_documents, mixing.apply_mix):
        out = stage(no_documents)
        assert out.columns == no_documents.columns and out.count() == 0


def test_distributed_newton_equals_the_solver_in_memory(spark):
    rng = np.random.default_rng(6)
    rows, want = [], {}
    for k, share in enumerate([0.01, 0.4, 1.0, 1.3, 1.9, 1.999999, 2.0, 2.5, 0.7]):
        size = np.unique(rng.integers(0, 5000, 60)) if k < 8 else np.zeros(1, dtype=int)
        n = rng.integers(1, 90, len(size))
        target = float(share * (size * n).sum())
        want[f"s{k}"] = dict(zip(size.tolist(), mixing.solve_dual(size.astype(float), n.astype(float), target)))
        rows += [(False, f"s{k}", int(s), int(c), int((size * n).sum()), target) for s, c in zip(size, n)]
    goals = spark.createDataFrame(rows, "no_source boolean, source_key string, size long, n long, source_size long, target double")
    got = mixing.solve_duals(goals.repartition(5)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert abs(r.rate - want[r.source_key][r["size"]]) < 1e-8 * max(1.0, want[r.source_key][r["size"]])


def test_lm_weight_sample_is_bounded_and_never_empty(spark):
    rows = [(i, None if i % 2 else f"text {i}") for i in range(3000)] + [(7, "a copy")] * 2000 + [(None, None)] * 50
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = lm_scoring.weight_sample(df, 5050, most=100).collect()
    assert len(got) == 100 and all(r.text is not None for r in got)
    assert [r.text for r in got] == [r.text for r in lm_scoring.weight_sample(df.repartition(2), 5050, most=100).collect()]
    few = lm_scoring.weight_sample(df.where("doc_id < 20 and text <> 'a copy'"), 10, most=100)
    assert few.count() == 10  # all rows with a text
    # the share of rows is a fraction of all hashes, not of 2**20 steps: some are left beyond 600 million documents
    many = spark.range(40_000_000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    assert lm_scoring.weight_sample(many, 700_000_000, most=500).count() > 50
