"""Quality rules with risk-controlled thresholds.

A rule rejects a document when a share computed from its text passes a cutoff. Which cutoffs may be used is decided on
labelled documents, per stratum (language): cutoffs are tested from the most lenient on with an exact binomial test of
"this cutoff rejects at least ``risk / rules`` of the good documents", and testing stops at the first cutoff for which
that cannot be refuted. Within one such sequence no correction is needed; across rules and strata the level is divided
(Bonferroni). With probability 1 - ``level``, then, no stratum loses more than ``risk`` of its good documents to all
rules together. Among the admitted cutoffs the one that pays best is taken; a rule without one is not used.
"""

from __future__ import annotations

import math
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from campflow.llm.common import free_name, stage

RISK, LEVEL = 0.05, 0.05
#: A rejected good document weighs as much as so many rejected bad ones when an admitted cutoff is picked.
COST = 10

#: Candidate cutoffs per rule, most lenient first; a document is rejected above them.
RULES: dict[str, tuple[float, ...]] = {
    "symbols": (0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.12, 0.1, 0.08, 0.06, 0.05, 0.04, 0.03, 0.02),
    "dup_lines": (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1),
    "capitals": (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2, 0.15, 0.1),
    "word_length": (40, 30, 25, 20, 18, 16, 14, 13, 12, 11, 10),
}

_SHARES = {
    "symbols": "n_symbols / greatest(word_chars, 1)",
    "dup_lines": "n_dup_lines / greatest(n_lines, 1)",
    "capitals": "n_capitals / greatest(n_letters, 1)",
    "word_length": "word_chars / greatest(n_words, 1)",
}

_SPACE, _SYMBOLS, _WINDOW = " \t\n\x0b\x0c\r", "#*$%&|<>", 5
_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letters", "n_capitals")


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a five-word window which the text has twice or more."""
    n = len(words)
    if n <= _WINDOW:
        return 0
    code = {w: i for i, w in enumerate(dict.fromkeys(words))}
    one = np.fromiter(map(code.__getitem__, words), np.int64, n)
    # windows get numbers below n, so that two of them fit into one long
    two = np.unique(one[:-1] * len(code) + one[1:], return_inverse=True)[1].astype(np.int64)
    found, four = np.unique(two[:-2] * n + two[2:], return_inverse=True)
    if len(found) == len(four):
        return 0
    _, five, times = np.unique(four[:-1].astype(np.int64) * n + one[4:], return_inverse=True, return_counts=True)
    edges = np.zeros(n + 1, np.int64)
    starts = np.flatnonzero(times[five] > 1)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + _WINDOW, -1)
    return int((np.cumsum(edges) > 0).sum())


def measures(text: str | None) -> tuple[int, ...]:
    """The counts of one text, in the order of ``_COUNTS``; null has none of anything."""
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()
    lines = [line for line in text.split("\n") if line.strip(_SPACE)]
    n_symbols = sum(map(text.count, _SYMBOLS))
    word_chars = len(text) - sum(map(text.count, _SPACE))
    if text.isascii():
        packed = np.frombuffer(text.encode(), np.uint8)
        capitals = int(((packed >= 65) & (packed <= 90)).sum())
        letters = capitals + int(((packed >= 97) & (packed <= 122)).sum())
    else:
        letters, capitals = sum(map(str.isalpha, text)), sum(map(str.isupper, text))
    return (len(words), word_chars, n_symbols, len(lines) - len(set(lines)), repeated_words(words), len(lines),
            letters, capitals)


def _measured(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([measures(t) for t in texts], columns=_COUNTS, dtype="int64")


def measured(docs: DataFrame, into: str) -> DataFrame:
    """``docs`` with a struct of the counts of ``text``."""
    counts = F.pandas_udf(_measured, ", ".join(f"{name} long" for name in _COUNTS))
    return docs.withColumn(into, counts("text"))


def _share(rule: str, within: str) -> F.Column:
    expression = _SHARES[rule]
    for name in _COUNTS:
        expression = expression.replace(name, f"`{within}`.{name}")
    return F.expr(expression)


def binomial_tail(rejected: int, of: int, risk: float) -> float:
    """P(at most ``rejected`` of ``of``) if each is rejected with probability ``risk``: the exact test's p-value."""
    if of == 0 or rejected >= of:
        return 1.0
    k = np.arange(1, rejected + 1, dtype=float)
    steps = np.log((of - k + 1) / k) + math.log(risk) - math.log1p(-risk)
    logs = of * math.log1p(-risk) + np.concatenate([[0.0], np.cumsum(steps)])
    top = logs.max()
    return min(1.0, float(np.exp(top) * np.exp(logs - top).sum()))


def cutoffs(docs: DataFrame, labels: DataFrame, risk: float = RISK, level: float = LEVEL) -> DataFrame:
    """``stratum`` and one column per rule: the cutoff in use, null where none is admitted.

    ``labels`` (doc_id, quality): 1 is good, 0 is bad, null says nothing; where labels of a document differ the
    highest counts. All labelled documents are counted. Strata are the values of ``lang``, null included.
    """
    sure = labels.filter("quality is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    known = measured(docs.select("doc_id", F.col("lang").alias("stratum"), "text"), "m").drop("text")
    known = known.select("doc_id", "stratum", *(_share(rule, "m").alias(rule) for rule in RULES)).join(sure, "doc_id")
    tried = F.array(*(
        F.struct(F.lit(rule).alias("rule"), F.lit(i).alias("nth"), F.lit(float(c)).alias("cutoff"),
                 (F.col(rule) > c).alias("rejected"))
        for rule, grid in RULES.items() for i, c in enumerate(grid)
    ))
    counts = (
        known.select("stratum", F.col("quality") == 1, F.explode(tried).alias("t"))
        .toDF("stratum", "good", "t").groupBy("stratum", "t.rule", "t.nth", "t.cutoff")
        .agg(F.count_if(F.col("good")).alias("good"), F.count_if(F.expr("good and t.rejected")).alias("good_out"),
             F.count_if(F.expr("not good and t.rejected")).alias("bad_out"))
    )
    counts = stage(counts, "risk")
    tests = max(1, counts.select("stratum").distinct().count() * len(RULES))

    def admitted(group: pd.DataFrame) -> pd.DataFrame:
        best, gain = None, 0
        for row in group.sort_values("nth").itertuples():
            if binomial_tail(int(row.good_out), int(row.good), risk / len(RULES)) > level / tests:
                break
            if row.bad_out - COST * row.good_out > gain:
                best, gain = row.cutoff, row.bad_out - COST * row.good_out
        first = group.iloc[0]
        return pd.DataFrame({"stratum": [first.stratum], "rule": [first["rule"]], "cutoff": [best]})

    # a group is one rule's grid in one stratum
    picked = counts.groupBy("stratum", "rule").applyInPandas(admitted, "stratum string, rule string, cutoff double")
    return stage(picked.groupBy("stratum").pivot("rule", list(RULES)).agg(F.max("cutoff")), "cutoffs")


def judged(docs: DataFrame, labels: DataFrame, risk: float = RISK, level: float = LEVEL) -> DataFrame:
    """``docs`` with the counts of :func:`measures`, ``base_failed``, ``broken`` (the rules it breaks) and ``kept``.

    ``base_failed``: under ten words, or over a fifth of the words in repeated five-word windows. ``kept``: neither
    that, nor above a cutoff of its stratum; a document of a stratum without labels meets the base rule only. Null and
    empty texts have no words and fail. Rows are judged one by one, so repeated rows and doc_ids get the same verdict.
    Extra columns are carried; those with the name of a new column are replaced.
    """
    cut = cutoffs(docs, labels, risk, level)
    inner = {name: free_name(docs, f"_{name}") for name in cut.columns}
    m = free_name(docs, "_m")
    out = measured(docs, m).join(cut.withColumnsRenamed(inner), F.col("lang").eqNullSafe(F.col(inner["stratum"])), "left")
    failed = F.expr(f"`{m}`.n_words < 10 or 100 * `{m}`.n_repeat_words > 20 * `{m}`.n_words")
    breaks = (F.when(_share(rule, m) > F.col(inner[rule]), F.lit(rule)) for rule in RULES)
    broken = F.array_compact(F.array(*breaks))
    counts = {name: F.col(f"`{m}`.{name}") for name in _COUNTS}
    out = out.withColumns(counts | {"base_failed": failed, "broken": broken})
    return out.withColumn("kept", ~F.col("base_failed") & (F.size("broken") == 0)).drop(m, *inner.values())


def kept_documents(docs: DataFrame, labels: DataFrame, risk: float = RISK, level: float = LEVEL) -> DataFrame:
    """The rows of ``docs`` that :func:`judged` keeps, with the columns of ``docs``."""
    own = docs.select("doc_id", "text", "lang", F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row_"))
    return judged(own, labels, risk, level).filter("kept").select("row_.*")
