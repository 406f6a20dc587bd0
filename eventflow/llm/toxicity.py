"""Toxicity: a factorization machine over hashed terms.

    score = sigmoid(b + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j)

x_i says whether a term that hashes to bucket i occurs in the text. The factors v learn
what a linear model misses: that two terms together mean more than either alone, such as
an insult with the mention of a group. The pair sum is taken in linear time as
half of (sum v)^2 - sum v^2 for each factor.

The machine is fitted on at most ``MAX_TRAIN`` labelled documents, taken by a hash of the
id, and as many of them as have ``MAX_TERMS`` distinct terms together; documents whose id hashes to the
held-out fifth are never among them. The sample's terms are gathered in tasks. Weights and factors go to the
buckets that tell something in the sample, by likelihood ratio, beyond what chance would give any
bucket: alone, or as a half of a pair. A pair tells something when its texts are toxic more or less often than
its halves' own shares add up to, so both halves may be neutral alone; pairs are counted among the
``PAIRED`` buckets that are most telling alone or else in most texts, as products of blocks of texts. Every text is then scored whole, in Arrow batches, with one
broadcast of a few hundred kilobytes whose size does not depend on the data.

Terms are words without ASCII punctuation at both ends, in ASCII lower case. Null and
empty texts have no terms and get the score of the bias. Labels that are null count as
absent; a document labelled more than once counts once, as toxic if any label says so.
Without labels of both kinds the score is the smoothed share of toxic labels. Repeated
rows are scored alike; label, language, source and id are no inputs of a score. A null
id counts as an empty string in the split.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventflow.llm.common import Words, buffers, col, fresh, map_rows, mix64, range_hash, slices, write_cut
from eventflow.llm.pii import _LOWER, _trim

BITS = 18
FEATURES = 4096
PAIRED, LEAST_PAIR = 2048, 10
FACTORS = 8
# Likelihood ratio beyond which a bucket tells something; by chance about one in all would.
TELLING = 2 * BITS * np.log(2)
MAX_TRAIN, MAX_TERMS = 20_000, 8_000_000
EPOCHS = 300


@dataclass
class Machine:
    place: np.ndarray   # bucket -> feature, -1 for none
    bias: float
    weight: np.ndarray
    factor: np.ndarray

    def score(self, row: np.ndarray, feature: np.ndarray, rows: int) -> np.ndarray:
        """Scores of texts given as sorted (row, feature) pairs."""
        out = np.full(rows, self.bias)
        out += np.bincount(row, weights=self.weight[feature], minlength=rows)
        for k in range(self.factor.shape[1]):
            v = self.factor[feature, k]
            total = np.bincount(row, weights=v, minlength=rows)
            out += 0.5 * (total * total - np.bincount(row, weights=v * v, minlength=rows))
        return 1.0 / (1.0 + np.exp(-np.clip(out, -40, 40)))


def terms(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of the distinct buckets of each text, sorted."""
    part = _LOWER[raw]
    w = Words(part, offsets)
    starts, ends = _trim(part, w.starts, w.ends)
    real = starts < ends
    bucket = (mix64(range_hash(part, starts[real], ends[real])) >> np.uint64(64 - BITS)).astype(np.int64)
    both = np.unique(w.row[real].astype(np.int64) << BITS | bucket)
    return both >> BITS, both & ((1 << BITS) - 1)


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def sample(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str,
           label_id: str, most: int) -> tuple[list[np.ndarray], np.ndarray]:
    """(buckets of each text, labels) of at most ``most`` labelled documents."""
    known = (labels.where(col(label).isNotNull() & col(label_id).isNotNull() & ~held_out(col(label_id)))
             .groupBy(col(label_id).alias("id")).agg(F.max(col(label).cast("int")).alias("toxic"))
             .orderBy(F.xxhash64("id"), "id").limit(most))
    own = (docs.select(col(doc_id).alias("id"), col(text).cast("string").alias("text"))
           .join(F.broadcast(known), "id"))  # at most ``most`` rows of two numbers

    def gather(texts: pa.Array) -> list[pa.Array]:
        raw, offsets = buffers(texts)
        out = []
        for a, b in slices(offsets):
            row, bucket = terms(raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
            edges = np.searchsorted(row, np.arange(b - a + 1))
            out += [bucket[i:j].astype("<i4").tobytes() for i, j in zip(edges, edges[1:])]
        return [pa.array(out, pa.binary())]

    found = map_rows(own, "text", [T.StructField("buckets", T.BinaryType())], gather, ["id", "toxic"])
    # A repeated document counts once, so that there are at most ``most`` rows.
    found = write_cut(found.groupBy("id", "toxic").agg(F.min("buckets").alias("buckets")), "sample")
    size = F.octet_length("buckets").cast("long")
    so_far = Window.orderBy(F.xxhash64("id"), "id").rowsBetween(Window.unboundedPreceding, 0)
    fits = found.select("id", F.sum(size).over(so_far).alias("_terms")).where(F.col("_terms") <= 4 * MAX_TERMS)
    got = found.join(F.broadcast(fits.select("id")), "id").orderBy("id").collect()  # at most ``most`` ids
    return ([np.frombuffer(r["buckets"], dtype="<i4").astype(np.int64) for r in got],
            np.array([r["toxic"] > 0 for r in got], dtype=np.float64))


def _ratio(toxic: np.ndarray, seen: np.ndarray, share) -> np.ndarray:
    """The likelihood ratio of shares of toxic texts against expected ones."""
    expected = seen * share
    return 2 * (toxic * np.log(np.maximum(toxic, 1e-9) / np.maximum(expected, 1e-9))
                + (seen - toxic) * np.log(np.maximum(seen - toxic, 1e-9) / np.maximum(seen - expected, 1e-9)))


def telling_pairs(row: np.ndarray, bucket: np.ndarray, y: np.ndarray, seen: np.ndarray, toxic: np.ndarray,
                  gain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(buckets that are halves of telling pairs, the greatest ratio of each)."""
    n, size = len(y), len(seen)
    order = np.lexsort((-seen, -np.where(gain > TELLING, gain, 0.0)))
    some = order[seen[order] >= LEAST_PAIR][:PAIRED]
    place = np.full(size, -1, dtype=np.int64)
    place[some] = np.arange(len(some))
    keep = place[bucket] >= 0
    row, own = row[keep], place[bucket[keep]]
    both, hit = np.zeros((len(some), len(some)), np.float32), np.zeros((len(some), len(some)), np.float32)
    step = 1024
    for a in range(0, n, step):
        i, j = np.searchsorted(row, (a, a + step))
        x = np.zeros((min(step, n - a), len(some)), np.float32)
        x[row[i:j] - a, own[i:j]] = 1
        both += x.T @ x
        bad = x[y[a:a + step] > 0]
        hit += bad.T @ bad
    share = (toxic[some] + 0.5 * y.mean()) / (seen[some] + 0.5)
    logit = np.log(share / (1 - share))
    common = float(np.log(y.mean() / (1 - y.mean())))
    best = np.zeros(len(some))
    least = 2 * np.log(max(len(some), 2) ** 2 / 2) + 8  # by chance about one pair in all, and some to spare
    for i in range(len(some)):
        j = np.flatnonzero(both[i] >= LEAST_PAIR)
        j = j[j != i]
        added = 1 / (1 + np.exp(-np.clip(logit[i] + logit[j] - common, -30, 30)))
        r = _ratio(hit[i, j].astype(np.float64), both[i, j].astype(np.float64), np.clip(added, 1e-6, 1 - 1e-6))
        # Halves that always stand together are one term, not a pair.
        r = np.where(both[i, j] < 0.95 * np.minimum(seen[some[i]], seen[some[j]]), r, 0.0)
        if len(r):
            best[i] = r.max()
    real = best > least
    return some[real], best[real]


def fit(buckets: list[np.ndarray], y: np.ndarray, seed: int = 7) -> Machine:
    """Full-batch Adam on the logistic loss with L2 on weights and factors."""
    n, size = len(y), 1 << BITS
    share = (y.sum() + 0.5) / (n + 1)
    place = np.full(size, -1, dtype=np.int32)
    empty = Machine(place, float(np.log(share / (1 - share))), np.zeros(1), np.zeros((1, FACTORS)))
    if not 0 < y.sum() < n:
        return empty
    row = np.repeat(np.arange(n), [len(b) for b in buckets])
    bucket = np.concatenate(buckets)
    seen = np.bincount(bucket, minlength=size).astype(np.float64)
    toxic = np.bincount(bucket, weights=y[row], minlength=size)
    gain = _ratio(toxic, seen, y.mean())
    halves, pair_gain = telling_pairs(row, bucket, y, seen, toxic, gain)
    gain = np.where(gain > TELLING, gain, 0.0)
    gain[halves] = np.maximum(gain[halves], pair_gain)
    best = np.argsort(-gain, kind="stable")[:FEATURES]
    best = best[gain[best] > 0]
    if not len(best):
        return empty
    place[best] = np.arange(len(best))
    keep = place[bucket] >= 0
    row, feature = row[keep], place[bucket[keep]].astype(np.int64)
    rng = np.random.RandomState(seed)
    params = {"b": np.array([empty.bias]), "w": np.zeros(len(best)),
              "v": rng.normal(0, 0.01, (len(best), FACTORS))}
    m1 = {k: np.zeros_like(p) for k, p in params.items()}
    m2 = {k: np.zeros_like(p) for k, p in params.items()}
    for step in range(1, EPOCHS + 1):
        machine = Machine(place, float(params["b"][0]), params["w"], params["v"])
        error = (machine.score(row, feature, n) - y) / n
        grad = {"b": np.array([error.sum()]),
                "w": np.bincount(feature, weights=error[row], minlength=len(best)) + 1e-6 * params["w"],
                "v": np.empty_like(params["v"])}
        own = np.bincount(feature, weights=error[row], minlength=len(best))
        for k in range(FACTORS):
            v = params["v"][:, k]
            total = np.bincount(row, weights=v[feature], minlength=n)
            grad["v"][:, k] = (np.bincount(feature, weights=error[row] * total[row], minlength=len(best))
                               - own * v + 1e-5 * v)
        for k, p in params.items():
            m1[k] = 0.9 * m1[k] + 0.1 * grad[k]
            m2[k] = 0.99 * m2[k] + 0.01 * grad[k] ** 2
            rate = (0.2 if k != "v" else 0.02)
            p -= rate * (m1[k] / (1 - 0.9 ** step)) / (np.sqrt(m2[k] / (1 - 0.99 ** step)) + 1e-8)
    return Machine(place, float(params["b"][0]), params["w"], params["v"])


def score(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
          label: str = "toxic", label_id: str = "doc_id", most: int = MAX_TRAIN,
          keep: list[str] | None = None, out: str = "score") -> DataFrame:
    """The ``keep`` columns of ``docs`` (default: all) and the score of each whole text, last and
    under ``out``, lengthened until it clashes with no column."""
    machine = fit(*sample(docs, labels, doc_id, text, label, label_id, most))
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def run(texts: pa.Array) -> list[pa.Array]:
        m = shared.value
        raw, offsets = buffers(texts)
        found = [np.zeros(0)]
        for a, b in slices(offsets):
            row, bucket = terms(raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
            feature = m.place[bucket]
            known = feature >= 0
            found.append(m.score(row[known], feature[known], b - a))
        return [pa.array(np.concatenate(found))]

    name = fresh(out, docs.columns if keep is None else keep)
    return map_rows(docs, text, [T.StructField(name, T.DoubleType(), False)], run, keep)
