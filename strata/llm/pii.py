"""Personal data in texts by weak supervision, in native expressions only.

Four base kinds are found by fixed patterns with a validity test each. Further
kinds start as generous candidates; four labelers vote on every one (a strict
pattern, a gazetteer of words in or before the span, the context around it, its
shape). Expectation-maximisation over the counts of the vote patterns estimates,
kind by kind and without any label, how often each labeler votes on true and on
false spans. Its posteriors are the targets of a logistic span classifier, which
sees the votes and features of the span itself (its length, its share of digits,
its letter cases) and so can trust, or drop, spans that the votes alone leave
open. Its weights become one column expression.

The tables that reach the driver hold one row per (kind, vote pattern, feature
code): at most kinds * 2**labelers * ``CODES`` rows, whatever the corpus.
Everything else is row-local.

The patterns are written so that no text makes them slow or deep: runs start
only where a run can start, and nothing repeats a group without a bound.

Defined cases: a null text is empty; no candidates anywhere leave the prior
weights; repeated rows are judged alike; an empty table gives an empty result;
other columns pass through ``redact_documents`` whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import fresh

_LOCAL = "A-Za-z0-9._%+-"
_LABEL = "A-Za-z0-9-"

#: Base kinds in their listed order. Each equals the plain pattern beside it, found leftmost and
#: without overlap, but starts only at the start of a run.
BASE = {
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[{_LABEL}]++(?=\.[{_LABEL}])"
    rf"[{_LABEL}.]+?(?=\.?(?:[^{_LABEL}.]|\z)|\.\.)",
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    # [0-9]([\x20-]?[0-9])+ of 14 to 19 digits
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){13,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
BASE_KINDS = tuple(BASE)


@dataclass(frozen=True)
class Kind:
    """A kind the labelers decide on: what may be one, and what speaks for it."""

    name: str
    #: A text without this has no candidate (a cheap test).
    needs: str
    candidate: str
    strict: str
    gazetteer: str
    shape: str
    #: Gazetteer words at the start of the span itself.
    inside: str = r"^\b$"


#: Candidate patterns, strict patterns and gazetteers.
KINDS = (
    Kind(
        "secret",
        r"[A-Za-z0-9_+/=-]{20}",
        r"(?<![A-Za-z0-9_+/=-])[A-Za-z0-9_+/=-]{20,}+",
        r"^(?:[0-9a-f]{32,}|[0-9A-F]{32,}|AKIA[0-9A-Z]{16}|gh[pousr]_\w{30,}|sk-[\w-]{20,}|xox[abp]-[\w-]{10,}|eyJ[\w-]{17,})$",
        r"(?i)(?:token|secret|passw(?:or)?d|pwd|api[_ -]?key|access[_ -]?key|key|bearer|credential)\W{0,4}$",
        r"^(?=.*[0-9].*[0-9])(?=.*[A-Za-z].*[A-Za-z])",
        r"(?i)^(?:\w+[_-])?(?:token|secret|passw(?:or)?d|pwd|key|bearer|credential)=",
    ),
    Kind(
        "ssn",
        r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
        r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
        r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$",
        r"(?i)(?:ssn|social security(?: number)?|sozialversicherung\w*|id)\W{0,4}$",
        r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$",
    ),
    Kind(
        "iban",
        r"[A-Z]{2}[0-9]{2}",
        r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
        r"^(?:AT|BE|CH|DE|DK|ES|FI|FR|GB|IE|IT|LU|NL|NO|PL|PT|SE)[0-9]{2}",
        r"(?i)(?:iban|account|konto|compte|cuenta)\W{0,4}$",
        r"^[A-Z]{2}[0-9]{2}(?: ?[0-9]){8}",
    ),
    Kind(
        "address",
        r"(?i)[(\[] ?at ?[)\]]|[(\[] ?dot ?[)\]]",
        r"(?i)(?<![A-Z0-9._%+-])[A-Z0-9._%+-]{1,64} ?[(\[] ?at ?[)\]] ?[A-Z0-9-]{1,63}(?: ?(?:\.|[(\[] ?dot ?[)\]]) ?[A-Z0-9-]{1,63}){1,4}",
        r"(?i)[(\[] ?dot ?[)\]] ?[a-z]{2,6}$|\.[a-z]{2,6}$",
        r"(?i)(?:e-?mail|mail|contact|write to|reach(?: me)? at|schreib\w*|contacto|courriel)\W{0,4}$",
        r"^[^ ]{2,}",
    ),
    Kind(
        "person",
        r"\b(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Mme|Sra|Señora|Señor|Monsieur|Madame)\b",
        r"(?<![\p{L}])(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Mme|Sra|Señora|Señor|Monsieur|Madame)\.? "
        r"\p{Lu}\p{Ll}{1,30}(?:[ -]\p{Lu}\p{Ll}{1,30}){0,2}",
        r"\p{Lu}\p{Ll}+ \p{Lu}\p{Ll}+$",
        r"(?i)(?:dear|by|from|contact|name|sincerely|von|par|por|de)\W{0,4}$",
        r"^(?:Mr|Mrs|Ms|Dr|Prof|Sra)\. |^(?:Herr|Frau|Mme|Señora|Señor|Monsieur|Madame) ",
    ),
)
LABELERS = ("strict", "gazetteer", "context", "shape")
#: Feature codes of a span: four values each of length, share of digits and letter cases.
FEATURES, CODES = 3, 64
LENGTHS = (24, 32, 48)
KIND_NAMES = (*BASE_KINDS, *(k.name for k in KINDS))
BEFORE = 24


def find_all(text: Column, pattern: str) -> Column:
    """Matches of a pattern as an array of (s, e, m): code points, end exclusive.

    The texts between the matches, and the matches, give the positions by running sums.
    """
    row = "array<struct<s:int,e:int,m:string>>"
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.zip_with(
        F.slice(F.split(text, pattern, -1), 1, F.size(found)),
        found,
        lambda gap, m: F.struct(F.length(gap).alias("gap"), F.length(m).alias("len"), m.alias("m")),
    )
    laid = F.aggregate(
        parts,
        F.struct(F.lit(0).alias("at"), F.array().cast(row).alias("out")),
        lambda acc, p: F.struct(
            (acc["at"] + p["gap"] + p["len"]).alias("at"),
            F.concat(
                acc["out"],
                F.array(
                    F.struct(
                        (acc["at"] + p["gap"]).alias("s"),
                        (acc["at"] + p["gap"] + p["len"]).alias("e"),
                        p["m"].alias("m"),
                    )
                ),
            ).alias("out"),
        ),
        lambda acc: acc["out"],
    )
    return F.when(F.size(found) > 0, laid).otherwise(F.array().cast(row))


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn_valid(digits: Column) -> Column:
    """The Luhn checksum of a string of digits."""
    places = F.split(F.reverse(digits), "")
    doubled = F.transform(
        F.filter(places, lambda d: d != ""),
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
            F.when(d.cast("int") > 4, d.cast("int") * 2 - 9).otherwise(d.cast("int") * 2)
        ),
    )
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d) % 10 == 0


def _valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        part = lambda p: F.regexp_replace(p, "^0+(?=[0-9])", "")
        return F.forall(F.split(m, r"\."), lambda p: (F.length(part(p)) <= 3) & (F.left(part(p), F.lit(3)).cast("int") <= 255))
    if kind == "card":
        return luhn_valid(_digits(m))
    if kind == "phone":
        return F.length(_digits(m)).between(10, 15)
    return F.lit(True)


def base_spans(text: Column, kind: str) -> Column:
    """Valid base spans of one kind, as an array of (s, rank, e)."""
    has = F.contains(text, F.lit("@")) if kind == "email" else text.rlike("[0-9]")
    rank = BASE_KINDS.index(kind)
    spans = F.transform(
        F.filter(find_all(text, BASE[kind]), lambda x: _valid(kind, x["m"])),
        lambda x: F.struct(x["s"].alias("s"), F.lit(rank).alias("rank"), x["e"].alias("e")),
    )
    return F.when(has, spans).otherwise(F.array().cast("array<struct<s:int,rank:int,e:int>>"))


def candidates(text: Column, kind: Kind) -> Column:
    """Candidate spans of one kind with the votes of every labeler, as (s, rank, e, votes)."""

    def judged(x: Column) -> Column:
        start = F.greatest(x["s"] - BEFORE, F.lit(0))
        before = F.substring(text, start + 1, x["s"] - start)
        after = F.substring(text, x["e"] + 1, F.lit(1))
        whole = (before == "") | before.rlike(r"[^\p{L}\p{N}]$")
        closed = (after == "") | after.rlike(r"^[^\p{L}\p{N}]")
        votes = (
            x["m"].rlike(kind.strict),
            before.rlike(kind.gazetteer) | before.rlike(r"(?:=|:)\s?[\"']?$") | x["m"].rlike(kind.inside),
            whole & closed,
            x["m"].rlike(kind.shape),
        )
        bits = sum((v.cast("int") * (1 << i) for i, v in enumerate(votes)), F.lit(0))
        return F.struct(
            x["s"].alias("s"),
            F.lit(KIND_NAMES.index(kind.name)).alias("rank"),
            x["e"].alias("e"),
            bits.alias("votes"),
            _features(x["m"]).alias("code"),
        )

    spans = F.transform(find_all(text, kind.candidate), judged)
    return F.when(text.rlike(kind.needs), spans).otherwise(
        F.array().cast("array<struct<s:int,rank:int,e:int,votes:int,code:int>>")
    )


def _features(m: Column) -> Column:
    """The feature code of a span: base 4 digits for length, share of digits, letter cases."""
    size, digits = F.length(m), F.length(F.regexp_replace(m, "[^0-9]", ""))
    length = sum(((size >= n).cast("int") for n in LENGTHS), F.lit(0))
    share = (digits > 0).cast("int") + (digits * 4 >= size).cast("int") + (digits * 8 >= size * 5).cast("int")
    cases = m.rlike(r"\p{Ll}").cast("int") + m.rlike(r"\p{Lu}").cast("int") * 2
    return length + share * 4 + cases * 16


@dataclass(frozen=True)
class SpanModel:
    """Per kind: the logistic weights (bias, labelers, feature values) and the labelers' (hit, false) rates."""

    weights: dict[str, tuple[float, ...]]
    rates: dict[str, tuple[tuple[float, float], ...]]

    @property
    def reliability(self) -> tuple[tuple[float, float], ...]:
        return tuple(r for k in self.rates.values() for r in k)

    def score(self, kind: str, votes: int, code: int = 0) -> float:
        """Log odds that a candidate is a span of its kind."""
        return float(_inputs([votes], [code])[0] @ np.array(self.weights[kind]))

    def score_column(self, kind: str, votes: Column, code: Column) -> Column:
        """The same as a column expression."""
        w = self.weights[kind]
        total = F.lit(w[0])
        for i in range(len(LABELERS)):
            total = total + F.lit(w[1 + i]) * F.shiftright(votes, i).bitwiseAND(F.lit(1))
        for i in range(FEATURES):
            at = 1 + len(LABELERS) + 4 * i
            value = F.shiftright(code, 2 * i).bitwiseAND(F.lit(3))
            total = total + F.get(F.array(*[F.lit(x) for x in w[at : at + 4]]), value)
        return total


def _inputs(votes, codes) -> np.ndarray:
    """A row per candidate pattern: 1, the votes, and each feature as four indicators."""
    votes, codes = np.asarray(votes, dtype=int), np.asarray(codes, dtype=int)
    bits = [(votes >> i & 1) for i in range(len(LABELERS))]
    values = [np.eye(4)[codes >> 2 * i & 3] for i in range(FEATURES)]
    return np.column_stack([np.ones(len(votes)), *bits, *values])


#: Rates of votes on true and on false spans that each labeler is believed to have before anything is
#: counted (a strict pattern hardly ever fires by chance), and what that belief is worth: some spans
#: and a share of those counted, so the corpus decides and no rate becomes 0 or 1.
HIT, FALSE, BELIEF, BELIEF_SHARE = (0.7, 0.7, 0.9, 0.9), (0.005, 0.1, 0.6, 0.4), 10.0, 0.1
#: Candidates that a kind's classifier weighs at most, and the width of the normal prior of a weight.
WEIGHED, WIDTH = 1000.0, 2.0


def estimate(counts: dict[tuple, int], rounds: int = 100) -> SpanModel:
    """EM for the labelers' rates, kind by kind, and a logistic classifier on its posteriors.

    ``counts`` has the number of candidates per (kind, votes) or (kind, votes, feature code).
    """
    weights, rates = {}, {}
    for kind in (k.name for k in KINDS):
        keys = sorted((k[1], k[2] if len(k) > 2 else 0) for k in counts if k[0] == kind)
        n = np.array([float(counts.get((kind, *k), counts.get((kind, k[0]), 0))) for k in keys])
        x = _inputs([k[0] for k in keys], [k[1] for k in keys])
        weights[kind], rates[kind] = _trained(x, n, rounds)
    return SpanModel(weights, rates)


def _trained(x: np.ndarray, n: np.ndarray, rounds: int):
    """The classifier's weights and the labelers' rates of one kind.

    A span is true with the odds that its features give, and each labeler votes by its rates.
    Expectation: the posterior of each pattern. Maximisation: the rates, and the features' odds.
    """
    j = len(LABELERS)
    bits, spans = x[:, 1 : 1 + j], x[:, [0, *range(1 + j, x.shape[1])]]
    hit, false = np.array(HIT), np.array(FALSE)
    belief = BELIEF + BELIEF_SHARE * n.sum()
    odds = np.zeros(spans.shape[1])
    for _ in range(rounds):
        weight = np.log(hit / (1 - hit)) - np.log(false / (1 - false))
        bias = float(np.log((1 - hit) / (1 - false)).sum())
        post = 1 / (1 + np.exp(-np.clip(bits @ weight + bias + spans @ odds, -500, 500)))
        true_n, false_n = float((n * post).sum()), float((n * (1 - post)).sum())
        hit = (bits.T @ (n * post) + np.array(HIT) * belief) / (true_n + belief)
        false = (bits.T @ (n * (1 - post)) + np.array(FALSE) * belief) / (false_n + belief)
        hit = np.maximum(hit, false)  # a vote never speaks against a span
        odds = _logistic(spans, n, post, np.zeros(len(odds)))
    rates = tuple((float(h), float(f)) for h, f in zip(hit, false))
    middle = np.concatenate([[bias + odds[0]], weight, odds[1:]])
    return tuple(float(v) for v in _logistic(x, n, post, middle)), rates


def _logistic(x: np.ndarray, n: np.ndarray, post: np.ndarray, middle: np.ndarray) -> np.ndarray:
    """Weighted logistic regression by Newton steps on soft targets, with a normal prior around ``middle``."""
    w = middle.copy()
    scale = n * min(1.0, WEIGHED / max(1.0, n.sum()))
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (scale * (post - p)) - (w - middle) / WIDTH**2
        hess = (x.T * (scale * p * (1 - p))) @ x + np.eye(len(w)) / WIDTH**2
        step = np.clip(np.linalg.solve(hess, grad), -2, 2)
        w = w + step
        if np.abs(step).max() < 1e-9:
            break
    return w


def fit(df: DataFrame, text: str = "text") -> SpanModel:
    """Count the vote and feature patterns of all candidates of ``df`` and estimate the model."""
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    spans = df.select(t.alias("t")).select(F.explode(F.concat(*[candidates(F.col("t"), k) for k in KINDS])).alias("c"))
    rows = spans.groupBy("c.rank", "c.votes", "c.code").agg(F.count(F.lit(1)).alias("n")).collect()
    return estimate({(KIND_NAMES[r["rank"]], r["votes"], r["code"]): r["n"] for r in rows})


def annotate(df: DataFrame, model: SpanModel, keep: list[Column], text: str = "text") -> DataFrame:
    """``keep``, the text ``_t``, base spans per kind, and all spans sorted by start, then kind."""
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))

    def extra(k: Kind) -> Column:
        good = F.filter(candidates(F.col("_t"), k), lambda c: model.score_column(k.name, c["votes"], c["code"]) > 0)
        return F.transform(good, lambda c: F.struct(c["s"].alias("s"), c["rank"].alias("rank"), c["e"].alias("e")))

    names = [f"_n{i}" for i in range(len(keep))]
    out = df.select(*[c.alias(n) for c, n in zip(keep, names)], t.alias("_t"))
    out = out.select(
        *names,
        "_t",
        *[base_spans(F.col("_t"), k).alias(f"_{k}") for k in BASE_KINDS],
        F.concat(*[extra(k) for k in KINDS]).alias("_extra"),
    )
    base = F.sort_array(F.concat(*[F.col(f"_{k}") for k in BASE_KINDS]))
    out = out.withColumn("_base", base)
    outside = F.filter(
        "_extra", lambda x: ~F.exists("_base", lambda b: (b["s"] < x["e"]) & (x["s"] < b["e"]))
    )  # a span that a base kind covers is already found
    return out.withColumn("_spans", F.sort_array(F.concat("_base", outside)))


def listing(spans: Column) -> Column:
    """kind:start:end of every span, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KIND_NAMES])
    return F.array_join(
        F.transform(
            spans,
            lambda x: F.concat_ws(":", F.element_at(kinds, x["rank"] + 1), x["s"].cast("string"), x["e"].cast("string")),
        ),
        ",",
    )


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span (sorted by start) replaced by its kind in angle brackets."""
    kinds = F.array(*[F.lit(f"<{k.upper()}>") for k in KIND_NAMES])
    walked = F.aggregate(
        spans,
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda acc, x: F.struct(
            F.greatest(acc["at"], x["e"]).alias("at"),
            F.when(
                x["s"] >= acc["at"],
                F.concat(
                    acc["out"], F.substring(text, acc["at"] + 1, x["s"] - acc["at"]), F.element_at(kinds, x["rank"] + 1)
                ),
            )
            .otherwise(acc["out"])
            .alias("out"),
        ),
        lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.lit(2**31 - 1))),
    )
    return F.when(F.size(spans) > 0, walked).otherwise(text)


def redact_documents(df: DataFrame, text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """``df`` with all found spans replaced in its text (null stays null) and its length updated."""
    model = fit(df, text)
    box = fresh(df, "_row")
    whole = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    found = annotate(df, model, [whole, F.col(f"`{text}`").isNull()], text)
    found = found.select(
        F.col("_n0").alias(box), F.when(~F.col("_n1"), redacted(F.col("_t"), F.col("_spans"))).alias("_clean")
    )

    def column(c: str) -> Column:
        if c == text:
            return F.col("_clean").alias(c)
        if c == length:
            kind = df.schema[c].dataType
            changed = ~F.col("_clean").eqNullSafe(F.col(box)[text])
            return F.when(changed, F.length("_clean").cast(kind)).otherwise(F.col(box)[c]).alias(c)
        return F.col(box)[c].alias(c)

    return found.select(*[column(c) for c in df.columns])


def find(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the id, base counts, the digest of the base spans and the list of all spans."""
    found = annotate(df, fit(df, text), [F.col(f"`{doc_id}`")], text)
    return found.select(
        F.col("_n0").alias("doc_id"),
        *[F.size(f"_{k}").cast("long").alias(f"n_{k}") for k in BASE_KINDS],
        F.sha2(listing(F.col("_base")), 256).alias("base_sha256"),
        listing(F.col("_spans")).alias("spans"),
    )
