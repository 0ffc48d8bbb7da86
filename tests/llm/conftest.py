import pytest

SF = "/root/testdata/sf0.001"

#: Texts that ask for every defined case.
ODD = [
    None, "", " \t\n ", "a", "one two three", "The the THE", "Ünïcödé wörds über alles", "x" * 3000,
    "word " * 2000, "line one here\n" * 40, "mail a.b@c.example.com and 10.0.0.1 or +1 (222) 333-4444 now",
    "card 4111 1111 1111 1111 and 4111-1111-1111-1112", "1 2 3 4 5 " * 400, "a@b.c_d@e.f..g@h.i.", "1.2.3.4.5.6.7.8 999.1.1.1",
    'token = "0123456789abcdef0123456789abcdef01234567" end', "🙂 emoji x@y.zz 🙂", "<|endoftext|> </turn> \\", "0" * 5000,
]


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Driver documents plus odd texts, repeated rows, null ids and sources, and columns with clashing names."""
    base = [(r.doc_id, r.text, r.lang, r.source) for r in spark.read.parquet(f"{SF}/documents.parquet").limit(60).collect()]
    base.sort(key=lambda r: r[0])
    odd = [(100_000 + i, t, None if i % 3 else "en", None if i % 4 == 0 else "src1") for i, t in enumerate(ODD)]
    rows = base + odd + base[:5] + [(None, base[0][1], "en", "src2"), (None, None, None, None), odd[7], odd[7]]
    schema = "doc_id long, text string, lang string, source string, n_chars long, size string, _row string, fp long, Row long"
    full = [(*r, None if r[1] is None else len(r[1]), "clash", "clash", 7, 8) for r in rows]
    return spark.createDataFrame(full, schema).repartition(5)


@pytest.fixture(scope="session")
def no_documents(odd_documents):
    return odd_documents.limit(0)


@pytest.fixture(scope="session")
def as_table(spark, tmp_path_factory):
    """Write a frame as the only file of a table folder; gives the folder."""

    def write(df, name):
        root = str(tmp_path_factory.mktemp("tables"))
        df.write.parquet(f"{root}/{name}.parquet")
        return root

    return write


@pytest.fixture(scope="session")
def odd_dir(as_table, odd_documents):
    return as_table(odd_documents, "documents")


@pytest.fixture(scope="session")
def empty_dir(spark, as_table, no_documents):
    root = as_table(no_documents, "documents")
    for name in ("embeddings", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(f"{root}/{name}.parquet")
    return root
