"""Secret scans: fixed key patterns and sliding-window entropy, in SQL functions only.

A pattern's matches come from ``regexp_extract_all`` and the gaps between them from
``split``; running sums over both give every match's place in code points, without a
sentinel that a text could contain.

Entropy finds secrets without a known shape. A candidate is a run of key characters
of at least ``MIN_CHARS``. It is judged by its stretches of at least as many: the
maximal ones of letters and digits within it (padding after one makes it part of the
base64 run), and the run itself. A stretch's class is the narrowest that holds it (hexadecimal, letters and
digits, base64), so that a prefix such as ``key-`` or ``path/`` raises no bar. A window of ``window`` characters slides over it; the
counts of the characters and the sum of c * log2(c) are carried along, one character
in and one out at each step, so every step costs the same however long the window.
The entropy of a window is log2(w) - sum / w, and a candidate with a stretch
whose largest window reaches its class's threshold is a span of kind ``entropy``. The
allow list suppresses what it matches: UUIDs and paths a whole run; ordered runs of the
alphabet and the words of documentation examples the windows they stand in, as they cut
the run; a stretch without a digit or without a letter itself. A stretch that is a base
span makes no candidate of the run around it.

Null and empty texts have no spans. A text is scanned whole; repeated rows are
scanned alike; nothing moves between tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventflow.llm.common import col, fresh

ASSIGN = (r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"""
          r"""|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"AKIA[A-Z0-9]{12,}"      # all of AKIA[A-Z0-9]+ with 16 characters or more
HEX = r"[0-9a-f]{32,}"             # all of [0-9a-f]+ with 32 characters or more
KINDS = ("assign", "access", "hex", "entropy")

MIN_CHARS = 20
WINDOW = 20
# Bits a window of 20 characters must reach, by class.
THRESHOLDS = {"hex": 3.0, "alnum": 3.6, "base64": 3.8}
ALPHABET = "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/_-"
# What is never a secret.
ALLOW = (r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
         r"^[^0-9]*$", r"^[^A-Za-z]*$", r"(?i)example|sample|placeholder|changeme|xxxxxx",
         r"0123456789|abcdefghijkl|ABCDEFGHIJKL",
         r"^(/?[A-Za-z]+[0-9]{0,4}[/_-])+[A-Za-z]*[0-9]{0,4}$")
# Those that match a run whole, and those that match a part of it.
WHOLE = (ALLOW[0], ALLOW[5])
CUTS = f"(?:{ALLOW[4]}|{ALLOW[3]})"
# Stretches that are base spans of their own.
COVERED = f"^(?:{ACCESS}|{HEX})$"


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def matches(text: Column, pattern: str) -> Column:
    """array<struct<start, end, found>> of the leftmost non-overlapping matches of a
    pattern that never matches the empty string."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)

    def step(acc, pair):
        start = acc["at"] + F.char_length(pair["gap"])
        end = start + F.char_length(pair["found"])
        return F.struct(end.alias("at"), F.concat(acc["all"], F.array(F.struct(
            start.alias("start"), end.alias("end"), pair["found"].alias("found")))).alias("all"))

    empty = F.struct(F.lit(0).alias("at"),
                     F.array().cast("array<struct<start:int,end:int,found:string>>").alias("all"))
    pairs = F.filter(F.arrays_zip(gaps.alias("gap"), found.alias("found")),
                     lambda p: p["found"].isNotNull())
    return F.when(F.regexp_like(text, F.lit(pattern)), F.aggregate(pairs, empty, step, lambda a: a["all"])) \
        .otherwise(empty["all"])


def _c_log_c(c: Column) -> Column:
    return F.when(c <= 1, F.lit(0.0)).otherwise(c * F.log2(c))


def window_entropy(word: Column, window: int = WINDOW) -> Column:
    """The largest Shannon entropy (bits a character) of any ``window`` characters in a
    row; of the whole word when it is shorter."""
    size = F.char_length(word)
    width = F.least(F.lit(window), size)
    zero = F.array_repeat(F.lit(0), len(ALPHABET) + 1)
    start = F.struct(zero.alias("n"), F.lit(0.0).alias("s"), F.lit(0.0).alias("best"))

    def step(codes):
        def move(acc, i):
            come, gone = codes[i], F.when(i >= width, codes[F.greatest(i - width, F.lit(0))]).otherwise(-1)

            def swap(acc2):
                # The one character that comes, then the one that goes.
                plus = F.when(come == gone, F.lit(0.0)).otherwise(
                    _c_log_c(acc["n"][come] + 1) - _c_log_c(acc["n"][come]))
                minus = F.when((come == gone) | (gone < 0), F.lit(0.0)).otherwise(
                    _c_log_c(acc["n"][F.greatest(gone, F.lit(0))] - 1)
                    - _c_log_c(acc["n"][F.greatest(gone, F.lit(0))]))
                total = acc2 + plus + minus
                counts = F.transform(acc["n"], lambda c, k: c + (k == come).cast("int")
                                     - (k == gone).cast("int"))
                best = F.when(i >= width - 1, F.greatest(
                    acc["best"], F.log2(width.cast("double")) - total / width)).otherwise(acc["best"])
                return F.struct(counts.alias("n"), total.alias("s"), best.alias("best"))

            return _let(acc["s"], swap)
        return F.aggregate(F.sequence(F.lit(0), size - 1), start, move, lambda a: a["best"])

    codes = F.transform(F.filter(F.split(word, ""), lambda c: c != ""),
                        lambda c: F.instr(F.lit(ALPHABET), c))
    return F.when(size > 0, _let(codes, step)).otherwise(F.lit(0.0))


def _candidates(text: Column) -> Column:
    return matches(text, "[A-Za-z0-9+/_-]{%d,}={0,2}" % MIN_CHARS)


def _matches_any(value: Column, patterns) -> Column:
    found = F.lit(False)
    for pattern in patterns:
        found = found | F.regexp_like(value, F.lit(pattern))
    return found


def _stretches(run: Column) -> Column:
    """The distinct stretches of a run by which it is judged."""
    def of(piece):
        return F.concat(F.array(piece), F.regexp_extract_all(
            piece, F.lit("[A-Za-z0-9]{%d,}+(?!=)" % MIN_CHARS), F.lit(0)))

    pieces = F.filter(F.split(run, CUTS, -1), lambda p: F.char_length(p) >= MIN_CHARS)
    return F.filter(F.array_distinct(F.flatten(F.transform(pieces, of))),
                    lambda s: ~F.regexp_like(s, F.lit(COVERED)))


def _suspicious(run: Column) -> Column:
    """Whether a candidate is not allow-listed and has a telling stretch."""
    return F.when(_matches_any(run, WHOLE), F.lit(False)).otherwise(F.exists(_stretches(run), _telling))


def _telling(found: Column) -> Column:
    """Whether a stretch is not allow-listed and reaches its class's entropy."""
    allowed = _matches_any(found, ALLOW)
    limit = (F.when(F.regexp_like(found, F.lit("^(?:[0-9a-f]+|[0-9A-F]+)$")), F.lit(THRESHOLDS["hex"]))
             .when(F.regexp_like(found, F.lit("^[A-Za-z0-9]+$")), F.lit(THRESHOLDS["alnum"]))
             .otherwise(F.lit(THRESHOLDS["base64"])))
    # A case expression, so that an allowed candidate's entropy is not computed.
    return F.when(allowed, F.lit(False)).otherwise(window_entropy(found) >= limit)


def scan(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The ``keep`` columns of ``docs`` (default: all) and an array ``secrets``
    (lengthened until it clashes with no column) of struct(start, place, kind, end,
    found), in order of start and of ``KINDS``; places are code points, the end
    exclusive."""
    keep = docs.columns if keep is None else keep
    out, raw = fresh("secrets", docs), fresh("_t", docs)
    t = F.col(raw)

    def tagged(found: Column, kind: str) -> Column:
        return F.transform(found, lambda m: F.struct(
            m["start"].alias("start"), F.lit(KINDS.index(kind)).alias("place"),
            F.lit(kind).alias("kind"), m["end"].alias("end"), m["found"].alias("found")))

    long_enough = F.filter(matches(t, ASSIGN), lambda m: F.char_length(
        F.regexp_extract(m["found"], ASSIGN, 2)) >= 8)
    base = F.concat(tagged(long_enough, "assign"), tagged(matches(t, ACCESS), "access"),
                    tagged(matches(t, HEX), "hex"))

    def add(known: Column) -> Column:
        extra = F.filter(_candidates(t), lambda m: ~F.exists(
            known, lambda b: (b["start"] <= m["start"]) & (m["end"] <= b["end"]))
            & _suspicious(m["found"]))
        return F.array_sort(F.concat(known, tagged(extra, "entropy")))

    return (docs.select(*[col(c) for c in keep], F.coalesce(col(text).cast("string"), F.lit("")).alias(raw))
            .select(*[col(c) for c in keep], _let(base, add).alias(out)))


def spans_text(spans: Column, kinds: tuple[str, ...]) -> Column:
    """kind:start:end of the spans of the given kinds, comma-joined."""
    own = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(own, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
