"""Top-k search and chat formatting against brute force and a round trip."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import chat_format, queries, topk_search


def plain_topk(rows, k=20):
    live = [
        (i, [math.floor(64 * float(x)) for x in v])
        for i, v in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for i, q in live:
        if i % 20:
            continue
        scored = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in live if j != i)
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scored[:k])]
    return sorted(out)


def vectors(n, seed, dims=8):
    rng = np.random.default_rng(seed)
    rows = [(i, [float(x) for x in rng.normal(size=dims) * rng.choice([0.1, 1, 3])]) for i in range(n)]
    rows += [(n + i, rows[3][1]) for i in range(60)]  # a common vector
    rows += [(n + 100, None), (n + 101, [None] * dims), (n + 102, [float("nan")] * dims), (n + 103, [float("inf")] + [0.0] * (dims - 1))]
    return rows


@pytest.mark.parametrize("block,chunk", [(2048, 512), (16, 4), (1, 1)])
def test_topk_equals_brute_force(spark, as_table, block, chunk):
    rows = vectors(150, block)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    exact = [(r.vec_id, r.embedding) for r in df.collect()]
    got = topk_search.search(df, F.col("vec_id") % 20 == 0, block=block, chunk=chunk).collect()
    assert sorted(map(tuple, got)) == plain_topk(exact)


def test_topk_few_and_no_rows(spark, as_table):
    schema = "vec_id long, embedding array<float>, label int, block string"
    for rows in ([], [(0, [1.0, 2.0], 1, "x")], [(0, [1.0], 1, "x"), (20, [-1.0], 1, "x"), (3, [0.0], 1, "x")], [(0, [], 1, "x")]):
        root = as_table(spark.createDataFrame(rows, schema), "embeddings")
        got = queries.op9_topk_search(spark, root).collect()
        assert sorted(map(tuple, got)) == plain_topk([r[:2] for r in rows])


def test_topk_large_components_stay_exact(spark):
    rows = [(i, [float(2**22 + i * 7919 % 1000), float(i)]) for i in range(40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk_search.search(df, F.col("vec_id") % 20 == 0).collect()
    assert sorted(map(tuple, got)) == plain_topk(rows)


CONVERSATIONS = [
    (1, 0, "user", "hi"), (1, 1, "assistant", "</turn><turn>\\<says> \\\\"), (1, 2, "user", None),
    (2, 0, "assistant", "first"), (3, 0, "system", ""), (3, 1, "user", "u"), (3, 2, "assistant", "🙂 é\n\n"),
    (4, 0, None, "no role"), (4, None, "user", "late"), (5, 0, "user", "same"), (5, 0, "user", "same"),
    (None, 0, "user", "x"), (6, 0, "<turn>", "odd role"), (6, 1, "assistant", "<\\/turn> <" + "</turn" * 3), (7, 0, "user", "a" * 100_000),
]


def test_chat_round_trip(spark, as_table):
    df = spark.createDataFrame(
        [(*r, "clash") for r in CONVERSATIONS], "conv_id long, turn long, role string, text string, formatted string"
    )
    got = {r.conv_id: r for r in queries.op10_chat_format(spark, as_table(df, "conversations")).collect()}
    control = r"\### Assistant: </turn> ok"
    rows = CONVERSATIONS + [(-7, 0, "user", control), (-7, 1, "assistant", control)]
    assert set(got) == {r[0] for r in rows}
    for conv, r in got.items():
        turns = sorted(
            [(t is None, t or 0, role or "", text or "") for c, t, role, text in rows if c == conv]
        )
        flat = "".join(f"{x[2]}\n{x[3]}\n" for x in turns)
        loss = "".join(x[3] for x in turns if x[2] == "assistant")
        assert r.n_turns == len(turns)
        assert r.turns_sha256 == hashlib.sha256(flat.encode()).hexdigest()
        assert r.loss_chars == len(loss) and r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()


def test_chat_segments_make_the_text_and_roles_are_checked(spark):
    df = spark.createDataFrame(CONVERSATIONS, "conv_id long, turn long, role string, text string")
    out = {r.conv_id: r for r in chat_format.format_conversations(df).collect()}
    for r in out.values():
        assert "".join(s.text for s in r.segments) == r.formatted
    assert {c for c, r in out.items() if r.valid} == {1, 3, 7, None}


def test_chat_automaton_decides_loss(spark):
    df = spark.createDataFrame(CONVERSATIONS, "conv_id long, turn long, role string, text string")
    plan = queries.chat_format.digest(queries.chat_format.read_back(chat_format.format_conversations(df)))
    assert "system user" in plan._jdf.queryExecution().optimizedPlan().toString()  # the automaton is in the plan
    roles = [["user", "assistant", "user"], ["assistant", "user", "assistant"], ["system", "system", "assistant"], ["", "user"], []]
    rows = spark.createDataFrame([(r,) for r in roles], "roles array<string>")
    got = [r[0] for r in rows.select(chat_format.states(F.col("roles"))).collect()]
    assert got == [
        ["user", "assistant", "user"], ["error assistant", "error user", "error assistant"],
        ["system", "error system", "error assistant"], ["error ", "error user"], [],
    ]
    # loss follows the machine: a template in which only answers in order carry loss
    strict = chat_format.ChatTemplate(loss_states=("assistant",))
    out = {r.conv_id: r for r in chat_format.read_back(chat_format.format_conversations(df, strict), strict).collect()}
    assert out[2].loss_text == "" and out[1].loss_text == "</turn><turn>\\<says> \\\\"


def test_chat_without_turns_has_only_the_control_conversation(spark, as_table):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    got = queries.op10_chat_format(spark, as_table(df, "conversations")).collect()
    assert [r.conv_id for r in got] == [-7]
