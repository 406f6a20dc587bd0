"""Mixing sources to target weights, in DataFrame functions only.

Sources in code point order, null last, weigh ``weights`` in turn. Together they
share ``total_percent`` of all words; a target never exceeds ``max_epochs`` times its
source's words, and what it cannot take is shared out again by weight. In closed
form the targets are min(cap, level * weight): with sources sorted by cap / weight,
the level follows from running sums over the table of sources.

A source's documents are ordered by a hash of (seed, id, text), which is random but
the same on every run. The key range of a source is cut into equal slices of about
``slice_rows`` documents each, in proportion to its row count, so a source that holds a
third of all rows spreads over as many tasks as its size asks for, and equal rows are
the only ones that share a key. Words are summed per slice, the sums are
accumulated over the slices of a source (one small row each), and inside a slice a
window adds the documents before. A document in full epochs is taken whole; in the
last, partial one, documents are taken in key order and the one across the budget
gives exactly the words that are left.

Null texts have no words and nothing is taken from them. A null source is a source
of its own. Repeated rows are documents each. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventflow.llm.common import WORD, col, fresh, write_cut

WEIGHTS = (5, 2, 1)
TOTAL_PERCENT = 150
MAX_EPOCHS = 2
SLICE_ROWS = 4096
KEY_SPACE = 1 << 32


def targets(sizes: DataFrame, weights=WEIGHTS, total_percent: int = TOTAL_PERCENT,
            max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Rows with (source, source_size), one per source, with their ``target``."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    w = sizes.withColumn("_w", F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                                            (turn + 1).cast("int")))
    w = w.withColumn("_cap", (F.col("source_size") * max_epochs).cast("double"))
    everything = Window.partitionBy()
    want = F.sum("source_size").over(everything) * F.lit(total_percent / 100)
    by_ratio = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    # The level if exactly the sources before this one are full.
    level = ((want - F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
             / (F.sum("_w").over(everything) - F.coalesce(F.sum("_w").over(before), F.lit(0.0))))
    w = w.withColumn("_level", level)
    # The first source in this order that its level does not fill sets it for all.
    free = F.when(F.col("_cap") >= F.col("_level") * F.col("_w"),
                  F.struct(F.col("_cap") / F.col("_w"), F.col("source").isNull(), "source", "_level"))
    w = w.withColumn("_at", F.min(free).over(everything).getField("_level"))
    share = F.least(F.col("_cap"), F.col("_at") * F.col("_w"))
    return w.select(*sizes.columns, F.coalesce(share, F.col("_cap")).alias("target"))


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
        seed: str = "mix", weights=WEIGHTS, total_percent: int = TOTAL_PERCENT,
        max_epochs: int = MAX_EPOCHS, slice_rows: int = SLICE_ROWS,
        keep: list[str] | None = None) -> DataFrame:
    """The ``keep`` columns of ``docs`` (default: all) and a struct ``mixed``
    (lengthened until it clashes with no column): size, source_size, target, taken."""
    keep = docs.columns if keep is None else keep
    out = fresh("mixed", docs)
    words = F.regexp_count(F.coalesce(col(text).cast("string"), F.lit("")), F.lit(WORD))
    ident = F.concat_ws("\x01", F.lit(seed), F.coalesce(col(doc_id).cast("string"), F.lit("")),
                        F.coalesce(col(text).cast("string"), F.lit("")))
    # The source as a key that is never null.
    key = F.coalesce(F.concat(F.lit("="), col(source).cast("string")), F.lit("-"))
    digest = F.md5(ident)
    rows = docs.select(
        F.struct(*[col(c) for c in keep]).alias("_row"), key.alias("_s"), col(source).alias("source"),
        words.cast("long").alias("size"), digest.alias("_key"),
        F.conv(F.substring(digest, 1, 8), 16, 10).cast("long").alias("_at"))
    sizes = rows.groupBy("_s", "source").agg(F.sum("size").alias("source_size"),
                                             F.count(F.lit(1)).alias("n"))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    # Written, so that Spark knows its size and broadcasts it only when it is small.
    plan = write_cut(
        targets(sizes, weights, total_percent, max_epochs)
        .withColumn("_slices", F.ceil(F.col("n") / F.lit(slice_rows)).cast("long"))
        .withColumn("_epochs", epochs.cast("long"))
        .withColumn("_rest", F.round("target").cast("long") - F.col("_epochs") * F.col("source_size"))
        .drop("source", "n"), "mix")
    sliced = (rows.drop("source").join(plan, "_s").withColumn(
        "_slice", F.floor(F.col("_at") * F.col("_slices") / F.lit(float(KEY_SPACE)))))
    sums = sliced.groupBy("_s", "_slice").agg(F.sum("size").alias("_sum"))
    ahead = Window.partitionBy("_s").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("_s", "_slice", F.coalesce(F.sum("_sum").over(ahead), F.lit(0)).alias("_ahead"))
    within = (Window.partitionBy("_s", "_slice").orderBy("_key", "size")
              .rowsBetween(Window.unboundedPreceding, -1))
    placed = (sliced.withColumn("_in", F.coalesce(F.sum("size").over(within), F.lit(0)))
              .join(sums, ["_s", "_slice"]))
    left = F.col("_rest") - F.col("_ahead") - F.col("_in")
    taken = F.col("_epochs") * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), left))
    return placed.select(
        "_row.*", F.struct("size", "source_size", "target", taken.cast("long").alias("taken")).alias(out))


def boundaries(sizes: DataFrame, weights=WEIGHTS, total_percent: int = TOTAL_PERCENT, max_epochs: int = MAX_EPOCHS,
               slice_rows: int = SLICE_ROWS) -> DataFrame:
    """A row per source (_s, _epochs, _last, _left) from narrow rows (_s, source, size, _key,
    _at): what ``mix`` takes, told by the document at which the last epoch ends. Documents of
    smaller keys are taken whole in it, those of greater ones not at all, and ``_left`` words are
    left for the copies of the one with the key ``_last``. A null key means that all are taken."""
    totals = sizes.groupBy("_s", "source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    plan = write_cut(targets(totals, weights, total_percent, max_epochs)
                     .withColumn("_slices", F.ceil(F.col("n") / F.lit(slice_rows)).cast("long")).withColumn("_epochs", epochs)
                     .withColumn("_rest", F.round("target").cast("long") - F.col("_epochs") * F.col("source_size"))
                     .select("_s", "_slices", "_epochs", "_rest"), "mix")
    sliced = sizes.drop("source").join(plan, "_s").withColumn(
        "_slice", F.floor(F.col("_at") * F.col("_slices") / F.lit(float(KEY_SPACE))))
    sums = sliced.groupBy("_s", "_slice").agg(F.sum("size").alias("_sum"))
    ahead = Window.partitionBy("_s").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_ahead", F.coalesce(F.sum("_sum").over(ahead), F.lit(0)))
    here = sums.join(plan.select("_s", "_rest"), "_s").where(
        (F.col("_ahead") <= F.col("_rest")) & (F.col("_rest") < F.col("_ahead") + F.col("_sum"))).select("_s", "_slice", "_ahead")
    # The distinct keys of one slice of a source, copies together.
    keys = sliced.join(here, ["_s", "_slice"]).groupBy("_s", "_key", "_ahead", "_rest").agg(F.sum("size").alias("_sum"))
    within = Window.partitionBy("_s").orderBy("_key").rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("_rest") - F.col("_ahead") - F.coalesce(F.sum("_sum").over(within), F.lit(0))
    last = keys.withColumn("_left", left).where((F.col("_left") >= 0) & (F.col("_left") < F.col("_sum"))).groupBy("_s").agg(
        F.min("_key").alias("_last"), F.min_by("_left", "_key").alias("_left"))
    return plan.select("_s", "_epochs").join(last, "_s", "left")


def draw(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", seed: str = "mix",
         **options) -> DataFrame:
    """The mixed corpus with the columns of ``docs``: a row for every time a document
    is taken, the text of a partly taken one cut after its last word taken. Texts do not move: a
    source's last epoch ends at one document, and only the copies of that one are numbered."""
    s, key, size, taken, times, end = (fresh(n, docs) for n in ("_s", "_key", "_size", "_taken", "_epoch", "_end"))
    whole = F.coalesce(col(text).cast("string"), F.lit(""))
    digest = F.md5(F.concat_ws("\x01", F.lit(seed), F.coalesce(col(doc_id).cast("string"), F.lit("")), whole))
    rows = docs.select("*", F.coalesce(F.concat(F.lit("="), col(source).cast("string")), F.lit("-")).alias(s),
                       digest.alias(key), F.regexp_count(whole, F.lit(WORD)).cast("long").alias(size))
    narrow = write_cut(rows.select(F.col(s).alias("_s"), col(source).alias("source"), F.col(size).alias("size"),
                                   F.col(key).alias("_key"), F.conv(F.substring(key, 1, 8), 16, 10).cast("long").alias("_at")), "sizes")
    cut = write_cut(boundaries(narrow, **options), "boundaries")
    placed = rows.join(cut.select(F.col("_s").alias(s), F.struct("_epochs", "_last", "_left").alias(end)), s)
    epochs, last, left = (F.col(end).getField(c) for c in ("_epochs", "_last", "_left"))
    at_last = F.coalesce(F.col(key) == last, F.lit(False))
    before = F.coalesce(F.col(key) < last, F.lit(True))
    plain = placed.where(~at_last).withColumn(taken, F.when(before, F.col(size)).otherwise(F.lit(0)))
    copies = Window.partitionBy(s).orderBy(F.xxhash64(*[col(c) for c in docs.columns]))
    among = placed.where(at_last).withColumn(times, F.row_number().over(copies) - 1)
    among = among.withColumn(taken, F.greatest(F.lit(0), F.least(F.col(size), left - F.col(times) * F.col(size)))).drop(times)
    got = plain.unionByName(among).withColumn(taken, (epochs * F.col(size) + F.col(taken)).cast("long"))
    got = got.where(F.col(taken) > 0).withColumn(
        times, F.explode(F.sequence(F.lit(1), F.ceil(F.col(taken) / F.col(size)).cast("int"))))
    here = F.least(F.col(size), F.col(taken) - F.col(size) * (F.col(times) - 1))
    pieces = F.regexp_extract_all(col(text), F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0))
    short = F.array_join(F.slice(pieces, 1, here.cast("int")), "")
    return got.withColumn(text, F.when(here < F.col(size), short).otherwise(col(text))).select(*[col(c) for c in docs.columns])
