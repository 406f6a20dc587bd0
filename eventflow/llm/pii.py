"""Personal data: base patterns, and terms that give protected entities away.

Base spans are e-mail addresses, IP addresses, card and telephone numbers; their values
are the protected entities. What else reveals an entity is estimated from the corpus,
by information theory: a term that stands near an entity (``WINDOW`` words to either side)
discloses it to the degree

    PMI(term; entity) / IC(entity),   PMI = log2(n(t,e) N / (n(t) n(e))),  IC = log2(N / n(e)),

the share of the entity's information that the term carries, over documents: N in all,
n(e) with the entity, n(t) with the term anywhere, n(t,e) with the term near the entity.
A term seen near an entity in at least ``SUPPORT`` documents whose degree reaches
``GENERALISE`` is generalised in the documents that hold that entity, at every place
outside the base spans; from ``REMOVE`` on it is removed. Documents without a protected
entity are left as they are.

Terms are words, stripped of ASCII punctuation at both ends, in ASCII lower case. All
documents are counted. Counts are combined before they are shuffled; an entity or a text
that a third of all documents hold is one row per task. A null or empty text has no
spans; equal texts have equal spans; repeated rows count as documents each. Memory
follows the longest text.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventflow.llm.common import (WORD, Words, buffers, col, fresh, map_arrow, map_rows, mix64,
                                  range_hash, slices, write_cut)

KINDS = ("email", "ip", "card", "phone", "term")
BASE = KINDS[:4]
WINDOW = 5
SUPPORT = 3
GENERALISE, REMOVE = 0.8, 0.95

LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match that begins inside a run of digits would have begun with the run.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")
_WORD = re.compile(WORD)

PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_PUNCT = np.zeros(256, dtype=bool)
_PUNCT[list(PUNCTUATION)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _emails(text: str):
    """Matches of local@domain, from one @ to the next: linear in the text."""
    floor = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            floor = m.end()
            yield start, floor
        else:
            floor = at + 1
        at = text.find("@", floor)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind's place, end) of all base spans, in order."""
    out = [(a, 0, b) for a, b in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
                out.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= sum(map(str.isdigit, m[0])) <= 15:
                    out.append((m.start(), 3, m.end()))
    return sorted(out)


def _trim(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranges without the ASCII punctuation at both ends."""
    starts, ends = starts.copy(), ends.copy()
    open_ = starts < ends
    while open_.any():
        open_ &= starts < ends
        open_[open_] = _PUNCT[raw[starts[open_]]]
        starts[open_] += 1
    open_ = starts < ends
    while open_.any():
        open_ &= starts < ends
        open_[open_] = _PUNCT[raw[ends[open_] - 1]]
        ends[open_] -= 1
    return starts, ends


def _value(text: str, kind: int, start: int, end: int) -> str:
    found = text[start:end]
    return found.lower() if kind < 2 else "".join(filter(str.isdigit, found))


def _hashes(values: list[bytes]) -> list[int]:
    raw = np.frombuffer(b"".join(values), dtype=np.uint8)
    ends = np.cumsum([len(v) for v in values]).astype(np.int64)
    starts = ends - np.array([len(v) for v in values], dtype=np.int64)
    return range_hash(raw, starts, ends).view(np.int64).tolist()


def _contexts(text: str, spans: list[tuple[int, int, int]]) -> tuple[list[dict], list[dict]]:
    """(the distinct pairs of an entity and a term near it, the places of each term) of a
    text, outside its base spans."""
    words = [(m.start(), m.end()) for m in _WORD.finditer(text)]
    heads = [a for a, _ in words]
    free = []
    for a, b in words:
        while a < b and ord(text[a]) < 128 and _PUNCT[ord(text[a])]:
            a += 1
        while a < b and ord(text[b - 1]) < 128 and _PUNCT[ord(text[b - 1])]:
            b -= 1
        free.append((a, b))
    taken = np.zeros(len(words), dtype=bool)
    near = []
    for start, kind, end in spans:
        first = max(int(np.searchsorted(heads, start, side="right")) - 1, 0)
        last = int(np.searchsorted(heads, end, side="left"))
        taken[first:last] = True
        near.append((f"{KINDS[kind]}:{_value(text, kind, start, end)}", first, last))
    places = [i for i, (a, b) in enumerate(free) if a < b and not taken[i]]
    if not places:
        return [], []
    hashed = _hashes([bytes(_LOWER[np.frombuffer(text[slice(*free[i])].encode(), dtype=np.uint8)])
                      for i in places])
    term = dict(zip(places, hashed))
    pairs: dict = {}
    for e, (_, first, last) in zip(_hashes([x[0].encode() for x in near]), near):
        for i in [*range(max(0, first - WINDOW), first), *range(last, min(len(words), last + WINDOW))]:
            if i in term:
                pairs[e, term[i]] = None
    found: dict = {}
    for i in places:
        found.setdefault(term[i], []).append({"start": free[i][0], "end": free[i][1]})
    return ([{"entity": e, "term": t} for e, t in pairs],
            [{"term": t, "places": p} for t, p in found.items()])


SPANS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("place", T.IntegerType()),
                                  T.StructField("end", T.IntegerType())]))
NEAR = T.ArrayType(T.StructType([T.StructField("entity", T.LongType()), T.StructField("term", T.LongType())]))
WORDS = T.ArrayType(T.StructType([T.StructField("term", T.LongType()), T.StructField("places", T.ArrayType(
    T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])))]))
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("place", pa.int32()), ("end", pa.int32())]))
_NEAR = pa.list_(pa.struct([("entity", pa.int64()), ("term", pa.int64())]))
_PLACES = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
_TERMS = pa.list_(pa.struct([("term", pa.int64()), ("places", _PLACES)]))


def find_batch(texts: pa.Array) -> list[pa.Array]:
    """[base spans, entities, terms near them, places of all terms] of each text; the last
    two are empty without an entity."""
    spans, entities, near, words = [], [], [], []
    for text in texts.to_pylist():
        own = base_spans(text or "")
        spans.append([{"start": a, "place": k, "end": b} for a, k, b in own])
        pairs, places = _contexts(text, own) if own else ([], [])
        near.append(pairs)
        words.append(places)
        values = sorted({f"{KINDS[k]}:{_value(text, k, a, b)}" for a, k, b in own})
        entities.append(_hashes([v.encode() for v in values]) if values else [])
    return [pa.array(spans, _SPANS), pa.array(entities, pa.list_(pa.int64())), pa.array(near, _NEAR),
            pa.array(words, _TERMS)]


def _term_counts(docs: DataFrame, text: str) -> DataFrame:
    """(term, n): in how many documents each term occurs."""
    src = docs.select(col(text).cast("string").alias("_text"))

    def run(batches):
        for batch in batches:
            raw, offsets = buffers(batch.column(0))
            terms, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
            for a, b in slices(offsets):
                part = _LOWER[raw[offsets[a]:offsets[b]]]
                w = Words(part, offsets[a:b + 1] - offsets[a])
                h = range_hash(part, *_trim(part, w.starts, w.ends))
                # Once for each text: equal terms of a text stand together.
                _, first = np.unique(h + mix64(w.row.astype(np.uint64) + np.uint64(1)), return_index=True)
                t, n = np.unique(h[first], return_counts=True)
                terms.append(t)
                counts.append(n)
            t, back = np.unique(np.concatenate(terms), return_inverse=True)
            n = np.bincount(back, weights=np.concatenate(counts), minlength=len(t)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(t.view(np.int64)), pa.array(n)], names=["term", "n"])

    return src.mapInArrow(run, "term long, n long")


def disclosing(docs: DataFrame, found: DataFrame, text: str, support: int = SUPPORT,
               generalise: float = GENERALISE) -> DataFrame:
    """(entity, term, degree) of the terms that disclose an entity. ``found`` has the
    columns entities and near for every document."""
    total = found.agg(F.count(F.lit(1)).alias("all")).withColumn("one", F.lit(1))
    with_entity = (found.where(F.size("entities") > 0).select(F.explode("entities").alias("entity"))
                   .groupBy("entity").agg(F.count(F.lit(1)).alias("ne")))
    pairs = (found.where(F.size("near") > 0).select(F.explode("near").alias("x"))
             .groupBy("x.entity", "x.term").agg(F.count(F.lit(1)).alias("nte")).where(F.col("nte") >= support))
    pairs = write_cut(pairs.join(with_entity, "entity").withColumn("one", F.lit(1)).join(total, "one"), "pairs")
    # Only terms that could disclose something are counted throughout the corpus.
    wanted = write_cut(pairs.select("term").distinct(), "terms")
    with_term = _term_counts(docs, text).join(wanted, "term").groupBy("term").agg(F.sum("n").alias("nt"))
    pmi = F.log2(F.col("nte") * F.col("all") / (F.col("nt") * F.col("ne")))
    content = F.log2(F.col("all") / F.col("ne"))
    return (pairs.join(with_term, "term").where("ne < all")
            .select("entity", "term", (pmi / content).alias("degree")).where(F.col("degree") >= generalise))


def find(docs: DataFrame, text: str = "text", keep: list[str] | None = None,
         support: int = SUPPORT, generalise: float = GENERALISE) -> tuple[DataFrame, DataFrame]:
    """(found, terms): ``found`` has the ``keep`` columns of ``docs`` (default: none), the
    digest of the text and its base spans, a row for each row of ``docs``; ``terms`` has,
    by digest, the spans of the disclosing terms with their degrees."""
    keep = keep or []
    digest = fresh("digest", docs)
    whole = F.coalesce(col(text).cast("string"), F.lit(""))
    own = docs.withColumn(digest, F.unhex(F.md5(whole)))
    fields = [T.StructField("spans", SPANS), T.StructField("entities", T.ArrayType(T.LongType())),
              T.StructField("near", NEAR), T.StructField("words", WORDS)]
    packed = own.select(F.struct(*[col(c) for c in keep], F.lit(0).alias(fresh("_", keep))).alias("row"),
                        col(digest).alias("digest"), col(text).alias("text"))
    found = write_cut(map_rows(packed, "text", fields, find_batch, ["row", "digest"]), "found")
    known = write_cut(disclosing(docs, found, text, support, generalise), "disclosing")
    # Every place of a disclosing term in the documents that hold its entity: a row for each
    # distinct term of such a document, joined on the term, and the entity looked up in the row.
    placed = (found.where(F.size("words") > 0).select("digest", "entities", F.explode("words").alias("x"))
              .select("digest", "entities", "x.term", "x.places").join(known, "term")
              .where(F.array_contains("entities", F.col("entity"))))
    terms = (placed.groupBy("digest", "term").agg(F.max("degree").alias("degree"), F.first("places").alias("places"))
             .select("digest", "degree", F.explode("places").alias("p"))
             .groupBy("digest").agg(F.sort_array(F.collect_list(F.struct("p.start", "p.end", "degree"))).alias("terms")))
    return found, write_cut(terms, "terms")


def scan(docs: DataFrame, text: str = "text", keep: list[str] | None = None, **options) -> DataFrame:
    """(row, spans): ``row`` is a struct of the ``keep`` columns, ``spans`` an array of
    struct(start, place, end, degree) of base spans and disclosing terms, in order."""
    found, terms = find(docs, text, keep, **options)
    base = F.transform("spans", lambda s: F.struct(
        s["start"].alias("start"), s["place"].alias("place"), s["end"].alias("end"),
        F.lit(1.0).alias("degree")))
    more = F.transform("terms", lambda s: F.struct(
        s["start"].alias("start"), F.lit(4).alias("place"), s["end"].alias("end"), s["degree"].alias("degree")))
    return found.join(terms, "digest", "left").select("row", F.array_sort(F.concat(
        base, F.coalesce(more, F.filter(base, lambda s: F.lit(False))))).alias("spans"))


def replace(text: str, spans: list[tuple[int, int, int]], terms: list[dict]) -> str:
    """The text with base spans and terms replaced; where spans meet, the first names both."""
    marks = [(a, b, f"[{KINDS[k].upper()}]") for a, k, b in spans]
    marks += [(t["start"], t["end"], "" if t["degree"] >= REMOVE else "[TERM]") for t in terms]
    out, at = [], 0
    for a, b, name in sorted(marks, key=lambda m: (m[0], -m[1])):
        if a >= at:
            out += [text[at:a], name]
        at = max(at, b)
    return "".join([*out, text[at:]])


def sanitise(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` with every span of its texts replaced by its kind, and terms generalised or
    removed. Rows, other columns and null texts stay."""
    _, terms = find(docs, text, **options)
    key, spans = fresh("_digest", docs), fresh("_terms", docs)
    whole = F.coalesce(col(text).cast("string"), F.lit(""))
    rows = docs.withColumn(key, F.unhex(F.md5(whole))).join(
        terms.select(F.col("digest").alias(key), F.col("terms").alias(spans)), key, "left")
    schema = docs.schema
    place = docs.columns.index(text)

    def run(batches):
        for batch in batches:
            texts, extra = batch.column(place), batch.column(batch.num_columns - 1).to_pylist()
            new = [None if x is None else replace(x, base_spans(x), extra[i] or [])
                   for i, x in enumerate(texts.to_pylist())]
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            columns[place] = pa.array(new, texts.type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1])

    return map_arrow(rows.select(*[col(c) for c in docs.columns], col(spans)), run, schema)
