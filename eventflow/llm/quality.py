"""Quality rules with risk-controlled thresholds.

Every text gets counts (words, symbols, repeated lines, repeated five-word
windows). Fixed base rules reject some texts outright. Beyond them, each rule is
a measure with a ladder of cutoffs, and the cutoffs are chosen per stratum on
labelled holdouts: among labelled good texts of the stratum that pass the base
rules, ``x`` of ``n`` would be rejected by a cutoff. The cutoff is admissible
when an exact binomial test refutes a false-rejection rate of ``alpha``:
P(Bin(n, alpha) <= x) <= delta / m, the exact (Clopper-Pearson) upper bound lying
at or below ``alpha``; ``m`` counts all cutoffs of all rules in all strata
(Bonferroni), so with probability 1 - delta every chosen cutoff keeps its promise.
Each rule spends an equal part of the allowed rate, hence the rules of a stratum
together falsely reject at most ``alpha``. Of the admissible cutoffs of a rule the
one rejecting most is used. A stratum with too few labels has none: nothing
beyond the base rules is rejected there.

Null and empty texts have no words and fail the base rules. A null stratum is a
stratum of its own. Repeated rows are judged alike. Labels that are null count
as absent; a document labelled more than once counts once, as good only if all
its labels say so. Memory follows the longest text.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventflow.llm.common import Words, buffers, col, fresh, map_rows, mix64, slices, write_cut

SYMBOLS = b"#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

# The ladder of each rule: a text is rejected when its measure is at least the cutoff.
LADDERS = {
    "symbols": [0.01, 0.02, 0.03, 0.05, 0.08, 0.12, 0.2, 0.3],
    "dup_lines": [0.05, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.7],
    "repeats": [0.02, 0.04, 0.06, 0.08, 0.1, 0.12, 0.15, 0.18],
    "long_words": [8.0, 9.0, 10.0, 12.0, 15.0, 20.0, 30.0, 50.0],
    "short_words": [-2.0, -2.5, -3.0, -3.5],  # minus the mean length
}

FIELDS = [T.StructField(n, T.LongType(), False) for n in
          ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")]


def _repeats(w: Words) -> np.ndarray:
    """Per text: words lying in a five-word window that occurs twice or more in it."""
    n, rows = len(w.starts), len(w.per_row)
    if n < WINDOW:
        return np.zeros(rows, dtype=np.int64)
    h = w.hashes()
    win = np.zeros(n - WINDOW + 1, dtype=np.uint64)
    for k in range(WINDOW):
        win = mix64(win + h[k:n - WINDOW + 1 + k])
    at = np.flatnonzero(w.row[:n - WINDOW + 1] == w.row[WINDOW - 1:])
    key = win[at] + mix64(w.row[at].astype(np.uint64) + np.uint64(1))  # equal only within a text
    order = np.argsort(key, kind="stable")
    key = key[order]
    same = key[1:] == key[:-1]
    twice = np.zeros(len(key), dtype=bool)
    twice[1:] |= same
    twice[:-1] |= same
    first = at[order[twice]]
    mark = np.zeros(n + 1, dtype=np.int64)
    np.add.at(mark, first, 1)
    np.add.at(mark, first + WINDOW, -1)
    return np.bincount(w.row[np.cumsum(mark[:-1]) > 0], minlength=rows)


def _lines(raw: np.ndarray, offsets: np.ndarray, w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Per text: lines with a word, and those equal to an earlier one."""
    rows = len(offsets) - 1
    lines, dups = np.zeros(rows, np.int64), np.zeros(rows, np.int64)
    data = raw.tobytes()
    for i in range(rows):
        if w.per_row[i]:
            own = [x for x in data[offsets[i]:offsets[i + 1]].split(b"\n") if not x.isspace() and x]
            lines[i] = len(own)
            dups[i] = len(own) - len(set(own))
    return lines, dups


def measure(texts: pa.Array) -> list[pa.Array]:
    """The counts of ``FIELDS`` for every text."""
    raw, offsets = buffers(texts)
    symbol = np.zeros(256, dtype=bool)
    symbol[list(SYMBOLS)] = True
    out: list[list[np.ndarray]] = [[] for _ in FIELDS]
    for a, b in slices(offsets):
        part, own = raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
        w = Words(part, own)

        def per_text(flag: np.ndarray) -> np.ndarray:
            total = np.concatenate([[0], np.cumsum(flag, dtype=np.int64)])
            return total[own[1:]] - total[own[:-1]]

        chars = per_text(w.inside & ((part & 0xC0) != 0x80))
        lines, dups = _lines(part, own, w)
        for k, x in enumerate((w.per_row, chars, per_text(symbol[part]), lines, dups, _repeats(w))):
            out[k].append(x)
    return [pa.array(np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64)) for x in out]


def with_counts(docs: DataFrame, text: str = "text", prefix: str = "", keep=None) -> DataFrame:
    """``docs`` (or its ``keep`` columns) with the counts of each whole text."""
    fields = [T.StructField(prefix + f.name, f.dataType, False) for f in FIELDS]
    return map_rows(docs, text, fields, measure, keep)


def _base_failed(p: str):
    n = F.col(p + "n_words")
    return (n < MIN_WORDS) | (F.lit(100) * F.col(p + "n_repeat_words")
                              > F.lit(MAX_REPEAT_PERCENT) * n)


def _measures(p: str) -> dict:
    n = F.greatest(F.col(p + "n_words"), F.lit(1)).cast("double")
    chars = F.greatest(F.col(p + "word_chars"), F.lit(1)).cast("double")
    lines = F.greatest(F.col(p + "n_lines"), F.lit(1)).cast("double")
    return {
        "symbols": F.col(p + "n_symbols") / chars,
        "dup_lines": F.col(p + "n_dup_lines") / lines,
        "repeats": F.col(p + "n_repeat_words") / n,
        "long_words": F.col(p + "word_chars") / n,
        "short_words": -(F.col(p + "word_chars") / n),
    }


def binomial_tail(n: int, x: int, p: float) -> float:
    """P(Bin(n, p) <= x), summed exactly term by term in logarithms."""
    if x >= n:
        return 1.0
    logs = [math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)
            + k * math.log(p) + (n - k) * math.log1p(-p) for k in range(x + 1)]
    top = max(logs)
    return min(1.0, math.exp(top) * math.fsum(math.exp(v - top) for v in logs))


def admissible(n: int, x: int, alpha: float, delta: float) -> bool:
    """Whether ``x`` false rejections among ``n`` refute a rate of ``alpha`` or
    more at level ``delta``."""
    if n == 0 or x > alpha * n:
        return False
    return binomial_tail(n, x, alpha) <= delta


def thresholds(counted: DataFrame, labels: DataFrame, doc_id: str, stratum: str,
               label: str = "quality", label_id: str = "doc_id", prefix: str = "",
               alpha: float = 0.01, delta: float = 0.05) -> DataFrame:
    """(stratum, one cutoff column per rule): the chosen cutoffs, null where none
    is admissible. ``counted`` has the columns of :func:`with_counts`. The
    labelled rows are only aggregated; what is tested has a row per stratum."""
    good = (labels.where(col(label).isNotNull() & col(label_id).isNotNull())
            .groupBy(col(label_id).alias("_id")).agg(F.min(col(label)).alias("_good"))
            .where("_good = 1").select("_id"))
    hold = counted.where(~_base_failed(prefix)).select(
        col(doc_id).alias("_id"), col(stratum).alias("_stratum"),
        *[v.alias(f"_{k}") for k, v in _measures(prefix).items()]).join(good, "_id")
    # A repeated document is one trial, or the bounds would mean nothing: its greatest measures count.
    hold = hold.groupBy("_id").agg(F.min("_stratum").alias("_stratum"), *[
        F.max(f"_{k}").alias(f"_{k}") for k in _measures(prefix)])
    hits = [F.sum((F.col(f"_{r}") >= F.lit(c)).cast("long")).alias(f"{r}__{i}")
            for r, cuts in LADDERS.items() for i, c in enumerate(cuts)]
    counts = hold.groupBy("_stratum").agg(F.count(F.lit(1)).alias("_n"), *hits)
    strata = counts.agg(F.count(F.lit(1)).alias("_strata"))
    tests = sum(map(len, LADDERS.values()))

    def choose(batches):
        for pdf in batches:
            rows = []
            for rec in pdf.to_dict("records"):
                n, m = int(rec["_n"]), tests * int(rec["_strata"])
                row = {"_stratum": rec["_stratum"]}
                for rule, cuts in LADDERS.items():
                    fit = [c for i, c in enumerate(cuts)
                           if admissible(n, int(rec[f"{rule}__{i}"]), alpha / len(LADDERS), delta / m)]
                    row[f"_cut_{rule}"] = min(fit) if fit else None
                rows.append(row)
            yield type(pdf)(rows, columns=["_stratum", *(f"_cut_{r}" for r in LADDERS)])

    schema = T.StructType([T.StructField("_stratum", counts.schema["_stratum"].dataType)]
                          + [T.StructField(f"_cut_{r}", T.DoubleType()) for r in LADDERS])
    one = F.lit(1).alias("_one")
    return (counts.select("*", one).join(strata.select("*", one), "_one").drop("_one")
            .mapInPandas(choose, schema))


def judge(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
          stratum: str = "lang", alpha: float = 0.01, delta: float = 0.05,
          keep: list[str] | None = None) -> DataFrame:
    """The ``keep`` columns of ``docs`` (default: all), a struct of the counts and
    the verdicts ``base_failed`` and ``kept``, named ``verdict`` (lengthened until it
    clashes with no column). One row per row of ``docs``."""
    keep = docs.columns if keep is None else keep
    out = fresh("verdict", docs)
    p = "__q_"
    while any(c.lower().startswith(p) for c in docs.columns):
        p += "_"
    small = list(dict.fromkeys([doc_id, stratum]))
    counted = with_counts(docs, text, p, list(dict.fromkeys([*keep, *small])))
    if text in keep:  # measured twice rather than writing all texts once more
        narrow = with_counts(docs, text, p, small)
    else:
        narrow = counted = write_cut(counted, "counts")
    cuts = thresholds(narrow, labels, doc_id, stratum, prefix=p,
                      alpha=alpha, delta=delta)
    cuts = cuts.select(F.col("_stratum").alias(p + "stratum"),
                       *[F.col(f"_cut_{r}").alias(f"{p}cut_{r}") for r in LADDERS])
    rejected = F.lit(False)
    for rule, value in _measures(p).items():
        rejected = rejected | F.coalesce(value >= F.col(f"{p}cut_{rule}"), F.lit(False))
    joined = counted.join(cuts, col(stratum).eqNullSafe(F.col(p + "stratum")), "left")
    bad = _base_failed(p)
    verdict = F.struct(*[F.col(p + f.name).alias(f.name) for f in FIELDS],
                       bad.alias("base_failed"), (~bad & ~rejected).alias("kept"))
    return joined.select(*[col(c) for c in keep], verdict.alias(out))
