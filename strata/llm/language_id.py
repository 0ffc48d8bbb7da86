"""Language identification: word first, then character n-grams.

Known words add their log frequency in every language. A word the model does not
know falls back to its character n-grams: the longest length of which any n-gram
is known decides, from 5 down to 1.

The model is fitted on a bounded sample: about ``SAMPLE`` labelled documents per
language, chosen by a hash of the id (all of them where there are fewer), whole
texts; it keeps every word and n-gram of them. The sample bounds what is broadcast.
Prediction reads the text only, of any length.

Defined cases: a text that is null or has no letter is ``und`` with score 0, and
so is every text if nothing was learned; a text of unknown letters gets the most
frequent language; repeated rows are judged alike; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import map_arrow, stored

SAMPLE = 2000
LONGEST = 5
UNKNOWN = "und"
#: Unknown words whose fallback a worker remembers.
CACHE = 200_000

_WORD = re.compile(r"[^\W\d_]+")


def letters(text: str) -> list[str]:
    """Lower-case runs of letters."""
    return _WORD.findall(text.lower())


def grams(word: str, n: int) -> list[str]:
    """Character n-grams of a word between its borders."""
    w = f"_{word}_"
    return [w[i : i + n] for i in range(len(w) - n + 1)]


@dataclass
class Model:
    """Log frequencies: one row per known word or n-gram, one column per language."""

    languages: list[str]
    prior: np.ndarray
    words: dict[str, int]
    grams: dict[str, int]
    word_table: np.ndarray
    gram_table: np.ndarray

    def __post_init__(self):
        self.cache: dict[str, np.ndarray] = {}

    def fallback(self, word: str) -> np.ndarray:
        got = self.cache.get(word)
        if got is None:
            got = np.zeros(len(self.languages))
            for n in range(LONGEST, 0, -1):
                known = [self.grams[g] for g in grams(word, n) if g in self.grams]
                if known:
                    got = self.gram_table[known].mean(axis=0)
                    break
            if len(self.cache) >= CACHE:
                self.cache.clear()
            self.cache[word] = got
        return got

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.languages or text is None or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0
        total = self.prior.copy()
        counts = Counter(letters(text))
        rows, weights, n = [], [], 0
        for w, c in counts.items():
            n += c
            at = self.words.get(w)
            if at is None:
                total += c * self.fallback(w)
            else:
                rows.append(at)
                weights.append(c)
        if rows:
            total += np.array(weights, dtype=float) @ self.word_table[rows]
        best = int(total.argmax())
        share = np.exp((total - total[best]) / max(1.0, n) ** 0.5)
        return self.languages[best], float(share[best] / share.sum())


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Word and n-gram counts per language of one partition of the bounded sample."""
    found: Counter = Counter()
    for b in batches:
        for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist()):
            for w, c in Counter(letters(text)).items():
                found[lang, 0, w] += c
    table: Counter = Counter(found)
    for (lang, _, w), c in found.items():
        for n in range(1, LONGEST + 1):
            for g in grams(w, n):
                table[lang, n, g] += c
    keys = list(table)
    for i in range(0, len(keys), 50_000):
        part = keys[i : i + 50_000]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([k[0] for k in part], pa.string()),
                pa.array([k[1] for k in part], pa.int32()),
                pa.array([k[2] for k in part], pa.string()),
                pa.array([table[k] for k in part], pa.int64()),
            ],
            names=["lang", "n", "token", "c"],
        )


def fit(df: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", sample: int = SAMPLE) -> Model:
    """Fit on the labelled rows of ``df``; rows without a label or text are left out."""
    rows = df.select(
        F.col(f"`{lang}`").alias("lang"), F.col(f"`{text}`").alias("text"), F.xxhash64(F.col(f"`{doc_id}`")).alias("h")
    ).where("lang is not null and text is not null")
    docs = {r["lang"]: r["docs"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("docs")).collect()}
    languages = sorted(docs)
    if not languages:
        return Model([], np.zeros(0), {}, {}, np.zeros((0, 0)), np.zeros((0, 0)))
    in_lang = F.create_map(*[F.lit(x) for item in docs.items() for x in item])  # one entry per language
    place = F.col("h").cast("double") / F.lit(2.0**64) + 0.5
    chosen = rows.where(place * in_lang[F.col("lang")] < sample).select("lang", "text")
    counted = map_arrow(chosen, _count, "lang string, n int, token string, c long")
    counted = counted.groupBy("lang", "n", "token").agg(F.sum("c").alias("c"))
    total = stored(counted.groupBy("n", "token").agg(F.collect_list(F.struct("lang", "c")).alias("by")), "language_counts")
    # rows of the bounded sample; in one order, so that sums do not depend on the partitions
    word_rows, gram_rows = (total.where(c).toArrow().sort_by([("n", "ascending"), ("token", "ascending")]) for c in ("n = 0", "n > 0"))
    prior = np.log(np.array([docs[x] for x in languages], dtype=float) / sum(docs.values()))
    words, word_table = _table(word_rows, languages, [0])
    known, gram_table = _table(gram_rows, languages, range(1, LONGEST + 1))
    return Model(languages, prior, words, known, word_table, gram_table)


def _table(rows: pa.Table, languages: list[str], lengths) -> tuple[dict[str, int], np.ndarray]:
    """Smoothed log frequency of every token per language, within its n-gram length."""
    at = {x: i for i, x in enumerate(languages)}
    counts = np.zeros((rows.num_rows, len(languages)))
    tokens, n = rows.column("token").to_pylist(), rows.column("n").to_numpy()
    by = rows.column("by").combine_chunks()
    row = np.repeat(np.arange(rows.num_rows), np.diff(by.offsets.to_numpy()))
    one = by.flatten()
    column = np.array([at[x] for x in one.field("lang").to_pylist()], dtype=int)
    counts[row, column] = one.field("c").to_numpy()
    logs = np.zeros_like(counts)
    for k in lengths:
        mine = n == k
        if mine.any():
            logs[mine] = np.log((counts[mine] + 0.5) / (counts[mine].sum(axis=0) + 0.5 * mine.sum()))
    return {t: i for i, t in enumerate(tokens)}, logs


def predict(df: DataFrame, model: Model, row: Column, text: str = "text") -> DataFrame:
    """``row``, ``lang_pred`` and ``score`` of every row of ``df``."""
    src = df.select(row.alias("row"), F.col(f"`{text}`").alias("text"))
    shared = df.sparkSession.sparkContext.broadcast(model)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            out = [m.predict(t.as_py()) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays(
                [b.column("row"), pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.float64())],
                names=["row", "lang_pred", "score"],
            )

    return map_arrow(src, judge, f"row {src.schema['row'].dataType.simpleString()}, lang_pred string, score double")
