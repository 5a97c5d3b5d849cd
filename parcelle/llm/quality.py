"""Quality rules as a short-circuit cascade (DataFrame functions only).

A rule is a Boolean expression that is true where a document is rejected.  The
cascade measures each rule on a bounded sample (seconds per row, share of rows
rejected), orders the rules by rejection per cost and evaluates them in one
``CASE``: Spark stops at the first rule that rejects.  The order changes the
time a document takes, never whether it is kept.

Defined results: null text counts as empty (no words, rejected by ``few_words``);
a rule that yields null does not reject; repeated rows are judged alike; an
empty table gives an empty result; further columns pass through, also where
they carry the name of a measure (work columns have a reserved prefix).
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelle.llm.common import WS_CLASS, hash_sample, spill

#: Rows of the sample on which costs and selectivities are measured.
SAMPLE_ROWS = 400
SYMBOLS = "#*$%&|<>"  # fixed value
_TRIM = " \t\n\x0b\x0c\r"
_P = "__q_"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_exclaim")
#: Measures that need a work column of an earlier projection.
_NEEDS_WORDS = {"n_words", "word_chars", "n_repeat_words"}


def _count_of(text: Column, chars: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, chars, ""))).cast("long")


def with_measures(docs: DataFrame, names: tuple[str, ...] = MEASURES, text: str = "text") -> DataFrame:
    """``docs`` plus ``__q_<measure>`` long columns for the named measures.

    Words are ``[^\\x20\\x09-\\x0D]+`` of the whole text.  Repeated three-word
    windows are found inside the row by sorting (hash, position) pairs, so a
    long text costs n log n and nothing is shuffled."""
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    out = docs
    if _NEEDS_WORDS & set(names):
        trimmed = F.btrim(t, F.lit(_TRIM))
        out = out.withColumn(_P + "w", F.when(trimmed == "", F.array().cast("array<string>"))
                             .otherwise(F.split(trimmed, WS_CLASS + "+")))
    w = F.col(_P + "w")
    if "n_words" in names:
        out = out.withColumn(_P + "n_words", F.size(w).cast("long"))
    if "word_chars" in names:
        out = out.withColumn(_P + "word_chars", F.length(F.concat_ws("", w)).cast("long"))
    if "n_symbols" in names:
        out = out.withColumn(_P + "n_symbols", _count_of(t, SYMBOLS))
    if "n_exclaim" in names:
        out = out.withColumn(_P + "n_exclaim", _count_of(t, "!"))
    if {"n_lines", "n_dup_lines"} & set(names):
        out = out.withColumn(_P + "l", F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(_TRIM)) != ""))
        out = out.withColumn(_P + "n_lines", F.size(_P + "l").cast("long"))
        out = out.withColumn(_P + "n_dup_lines", (F.size(_P + "l") - F.size(F.array_distinct(_P + "l"))).cast("long"))
    if "n_repeat_words" in names:
        out = out.withColumn(_P + "h", F.when(F.size(w) > 3, F.transform(
            F.slice(w, F.lit(1), F.greatest(F.size(w) - 2, F.lit(0))), lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))))
        h = F.col(_P + "h")
        out = out.withColumn(_P + "s", F.when(F.size(F.array_distinct(h)) < F.size(h), F.sort_array(
            F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
        s = F.col(_P + "s")
        out = out.withColumn(_P + "p", F.sort_array(F.transform(F.filter(s, lambda x, i: (
            (i > 0) & (F.get(s, i - 1)["h"] == x["h"])) | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False))),
            lambda x: x["i"])))
        covered = F.aggregate(_P + "p", F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last")),
                              lambda a, x: F.struct((a["n"] + F.least(F.lit(3), x - a["last"])).alias("n"), x.alias("last")))["n"]
        out = out.withColumn(_P + "n_repeat_words", F.coalesce(covered, F.lit(0).cast("long")))
    return out.drop(*[_P + c for c in ("w", "l", "h", "s", "p") if c == "w" or _P + c in out.columns])


@dataclass(frozen=True)
class Rule:
    """``sql``: true where a document is rejected, over the named measures."""

    name: str
    measures: tuple[str, ...]
    sql: str


#: Base rules of the contract, then the cascade's own.  Lines and symbols are
#: set so that running prose in any script is far from every bound.
BASE_RULES = (
    Rule("few_words", ("n_words",), "__q_n_words < 50"),
    Rule("repeated_windows", ("n_words", "n_repeat_words"), "100 * __q_n_repeat_words > 50 * __q_n_words"),
)
OWN_RULES = (
    Rule("symbols", ("n_words", "n_symbols"), "3 * __q_n_symbols > __q_n_words"),
    Rule("repeated_lines", ("n_lines", "n_dup_lines"), "2 * __q_n_dup_lines > __q_n_lines"),
    Rule("shouting", ("n_words", "n_exclaim"), "2 * __q_n_exclaim > __q_n_words"),
    Rule("word_length", ("n_words", "word_chars"), "__q_word_chars < 2 * __q_n_words"),
)
RULES = BASE_RULES + OWN_RULES


def _all_measures(rules) -> tuple[str, ...]:
    return tuple(m for m in MEASURES if any(m in r.measures for r in rules))


def plan_cascade(docs: DataFrame, rules=RULES, text: str = "text", key: str = "doc_id",
                 sample_rows: int = SAMPLE_ROWS) -> list[dict]:
    """Measure the rules on at most ``sample_rows`` documents with the smallest
    key hashes and return them in cascade order: rejected share per second first."""
    narrow = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("text"))
    sample = spill(hash_sample(narrow, sample_rows, narrow.count(), "k").coalesce(1), "quality-sample")

    def timed(rule: Rule | None) -> tuple[float, float]:
        if rule is None:
            df, hit = sample, F.length("text") < 0
        else:
            df, hit = with_measures(sample, rule.measures), F.expr(rule.sql)
        t0 = time.perf_counter()
        share = df.agg(F.avg(F.coalesce(hit, F.lit(False)).cast("int"))).first()[0]
        return time.perf_counter() - t0, float(share or 0.0)

    timed(None)
    floor = timed(None)[0]
    found = []
    for r in rules:
        timed(r)  # compiles
        cost, share = timed(r)
        cost = max(cost - floor, 1e-4)
        found.append({"rule": r, "cost_s": cost, "rejects": share, "rate": share / cost})
    return sorted(found, key=lambda x: (-x["rate"], x["cost_s"]))


def cascade(docs: DataFrame, plan: list[dict], text: str = "text", out: str = "rejected_by") -> DataFrame:
    """``docs`` plus the name of the first rule of ``plan`` that rejects (null:
    kept).  Measures are computed in cascade order, each behind the rules before
    it: a document that a cheap rule rejects never reaches the dear ones."""
    df = docs.withColumn(_P + "out", F.lit(None).cast("string"))
    have: set[str] = set()
    for step in plan:
        r = step["rule"]
        new = tuple(m for m in r.measures if m not in have)
        if new:
            # a rejected document is measured as null text: at no cost
            df = df.withColumn(_P + "t", F.when(F.col(_P + "out").isNull(), F.col(f"`{text}`")))
            df = with_measures(df, new, _P + "t").drop(_P + "t")
            have |= set(new)
        df = df.withColumn(_P + "out", F.when(F.col(_P + "out").isNotNull(), F.col(_P + "out"))
                           .when(F.expr(r.sql), F.lit(r.name)))
    df = df.drop(*[_P + m for m in have])
    return df.drop(out).withColumnRenamed(_P + "out", out)


def keep_good(docs: DataFrame, rules=RULES, text: str = "text") -> DataFrame:
    """The documents that no rule rejects, columns as they were."""
    marked = cascade(docs, plan_cascade(docs, rules, text), text, _P + "verdict")
    # a filter would be pushed below the measures, which would then be computed
    # anew wherever the verdict names them; a generator stays where it is
    stay = F.array_repeat(F.lit(1), F.when(F.col(_P + "verdict").isNull(), 1).otherwise(0))
    return marked.withColumn(_P + "stay", F.explode(stay)).drop(_P + "verdict", _P + "stay")


def quality_report(docs: DataFrame) -> DataFrame:
    """Contract columns of every document, with the cascade's verdict.

    The contract wants every base measure of every document, so those are
    computed once for all; the cascade's own rules run only where no base rule
    has rejected."""
    plan = plan_cascade(docs, OWN_RULES)
    base = with_measures(docs.select("doc_id", "text"), ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"))
    base = base.withColumn("base_failed", F.expr(" OR ".join(f"({r.sql})" for r in BASE_RULES)))
    base = base.withColumn("__q_n_exclaim", F.when(~F.col("base_failed"), _count_of(F.coalesce("text", F.lit("")), "!")))
    verdict = F.when(F.col("base_failed"), F.lit(False))
    for step in plan:
        verdict = verdict.when(F.expr(step["rule"].sql), F.lit(False))
    return base.select("doc_id", *[F.col("__q_" + m).alias(m) for m in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
                       "base_failed", verdict.otherwise(True).alias("kept"))
