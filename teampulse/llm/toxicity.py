"""Toxicity by a factorization machine over hashed terms (operator 8).

A text's terms are its distinct lower-cased words (letters, digits and
non-ASCII bytes) and the first 4, 5 and 6 bytes of longer words, as 64-bit
hashes. The machine adds a weight per term and, per pair of terms, the product
of their factors, so a pair can weigh more (or less) than its parts: an insult
beside the mention of a group, say. The score is the logistic of the sum.

It is fitted on a bounded sample, at most `TOXIC_ROWS` toxic and `CLEAN_ROWS`
other labelled rows, chosen by a hash of the id; the intercept is corrected for
the sampling from counts over all labelled rows. Terms with a clear link to the
label (chi-square at least `MIN_CHI2`, in `MIN_ROWS` rows or more, at most
`MAX_TERMS` of them) take part; they are counted in Spark, and what reaches the
driver is the sample's rows in those terms.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from teampulse.llm import vec
from teampulse.llm.frames import filtered, stored

TOXIC_ROWS = 2500
CLEAN_ROWS = 5000
MIN_ROWS = 3
MIN_CHI2 = 15.0
MAX_TERMS = 1 << 14
FACTORS = 8
THRESHOLD = 0.3
PREFIXES = (4, 5, 6)

_BETWEEN = np.ones(256, bool)
for _low, _high in ((48, 58), (65, 91), (97, 123), (128, 256)):
    _BETWEEN[_low:_high] = False


def terms(data, offsets):
    """(row, hash) of every term of the rows of a byte buffer, repeats included."""
    data = vec.LOWER[data]
    starts, ends, first = vec.words(data, offsets, _BETWEEN)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    total, row = vec.prefix_hash(data), np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    rows, hashes = [row], [vec.span_hash(total, starts, ends)]
    for p in PREFIXES:
        longer = ends - starts > p
        rows.append(row[longer])
        hashes.append(vec.mix(vec.span_hash(total, starts[longer], starts[longer] + p) + np.uint64(p)))
    return np.concatenate(rows), np.concatenate(hashes)


def _sum_by(rows, values, n):
    return np.bincount(rows, values, n)


def raw_scores(model: dict, row, term, n: int) -> np.ndarray:
    """Sums of the machine for n rows from their distinct (row, number of a known term) pairs."""
    w, v = model["w"], model["v"]
    out = model["w0"] + _sum_by(row, w[term], n)
    for f in range(v.shape[1]):
        x = v[term, f]
        out += 0.5 * (_sum_by(row, x, n) ** 2 - _sum_by(row, x * x, n))
    return out


def score(model: dict, data, offsets) -> np.ndarray:
    """Scores, 0 to 1, of the rows of a byte buffer; a text without known terms gets the intercept's."""
    out = np.empty(len(offsets) - 1)
    known = model["terms"]
    for i, j in vec.slices(offsets):
        row, h = terms(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
        if len(known) and len(h):
            at = np.minimum(np.searchsorted(known, h), len(known) - 1)
            hit = known[at] == h
            pair = np.unique(row[hit] * len(known) + at[hit])
            row, at = pair // len(known), pair % len(known)
        else:
            row = at = np.zeros(0, np.int64)
        out[i:j] = raw_scores(model, row, at, j - i)
    return 1 / (1 + np.exp(-np.clip(out, -35, 35)))


def choose_terms(sample: DataFrame, rows: int, toxic: int) -> np.ndarray:
    """Sorted hashes of the terms to learn; sample: (toxic, terms: array) of `rows` rows, `toxic` of them toxic."""
    if not 0 < toxic < rows:
        return np.zeros(0, np.uint64)
    seen = F.col("seen").cast("double")
    expected = seen * (toxic / rows)
    spread = expected * (1 - toxic / rows) * (1 - seen / rows)
    chi2 = F.try_divide((F.col("bad") - expected) * (F.col("bad") - expected), spread)
    best = (sample.select("toxic", F.explode("terms").alias("term")).groupBy("term")
            .agg(F.count("*").alias("seen"), F.sum("toxic").alias("bad"))
            .where(F.col("seen") >= MIN_ROWS).withColumn("chi2", chi2).where(F.col("chi2") >= MIN_CHI2)
            .orderBy(F.col("chi2").desc(), "term").limit(MAX_TERMS))
    return np.sort(best.select("term").toArrow()["term"].to_numpy().view(np.uint64))


def fit(known, row, at, y, prior: float, epochs: int = 30, batch: int = 256, rate: float = 0.15, l2: float = 2e-4,
        seed: int = 3) -> dict:
    """A machine for the (row, number of a known term) pairs of rows with labels y (0/1), sorted by row; AdaGrad on the
    logistic loss. prior: the share of toxic rows outside the sample."""
    y = np.asarray(y, float)
    rng = np.random.default_rng(seed)
    model = {"terms": known, "w0": 0.0, "w": np.zeros(len(known)), "v": rng.normal(0, 0.02, (len(known), FACTORS))}
    share = np.clip(y.mean() if len(y) else 0.0, 1e-6, 1 - 1e-6)
    model["w0"] = float(np.log(share / (1 - share)))
    if len(known):
        begin = np.searchsorted(row, np.arange(len(y) + 1))
        sums = {"w0": 1e-8, "w": np.full(len(known), 1e-8), "v": np.full((len(known), FACTORS), 1e-8)}
        for _ in range(epochs):
            for part in np.array_split(rng.permutation(len(y)), max(1, len(y) // batch)):
                counts = begin[part + 1] - begin[part]
                own = np.repeat(np.arange(len(part)), counts)
                t = at[np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(begin[part], counts)]
                s = np.stack([_sum_by(own, model["v"][t, f], len(part)) for f in range(FACTORS)], axis=1)
                g = (1 / (1 + np.exp(-np.clip(raw_scores(model, own, t, len(part)), -35, 35))) - y[part]) / len(part)
                grad_v = g[own][:, None] * (s[own] - model["v"][t])
                full_v = np.stack([np.bincount(t, grad_v[:, f], len(known)) for f in range(FACTORS)], axis=1)
                for name, grad in (("w0", g.sum()), ("w", np.bincount(t, g[own], len(known)) + l2 * model["w"] / batch),
                                   ("v", full_v + l2 * model["v"] / batch)):
                    sums[name] = sums[name] + grad * grad
                    model[name] = model[name] - rate * grad / np.sqrt(sums[name])
    prior = np.clip(prior, 1e-6, 1 - 1e-6)
    model["w0"] = float(model["w0"] + np.log(prior / (1 - prior)) - np.log(share / (1 - share)))
    return model


def held_out(id_col):
    """True for ids whose labels are never learnt from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame) -> dict:
    """A machine from the labelled rows of docs that are not held out (a document labelled both ways counts as toxic)."""
    known = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out("doc_id"))
             .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")))
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}

    def sample(kind, bound):
        return known.where(F.col("toxic") == kind).orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)

    chosen = sample(1, TOXIC_ROWS).unionByName(sample(0, CLEAN_ROWS))  # bounded: broadcast
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "toxic", "text")

    def run(batches):
        for batch in batches:
            data, offsets = vec.buffers(batch.column(2))
            found = []
            for i, j in vec.slices(offsets):
                row, h = terms(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                order = np.lexsort((h, row))
                row, h = row[order], h[order]
                fresh = np.ones(len(h), bool)
                fresh[1:] = (np.diff(row) != 0) | (h[1:] != h[:-1])
                row, h = row[fresh], h[fresh]
                found += np.split(h, np.searchsorted(row, np.arange(1, j - i)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([x.view(np.int64) for x in found], pa.list_(pa.int64()))],
                ["doc_id", "toxic", "terms"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    sampled = stored(rows.mapInArrow(run, f"doc_id {kind}, toxic int, terms array<long>"), "toxicity-sample")
    n, toxic = sampled.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    known = choose_terms(sampled, n, toxic)

    def numbered(batches):
        for batch in batches:
            lists = []
            for found in batch.column(2):
                h = found.values.to_numpy().view(np.uint64)
                lists.append(np.flatnonzero(np.isin(known, h)).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(lists, pa.list_(pa.int32()))],
                                             ["doc_id", "toxic", "terms"])

    got = sampled.mapInArrow(numbered, f"doc_id {kind}, toxic int, terms array<int>").orderBy("doc_id", "terms").toArrow()
    lists = [x.values.to_numpy() for x in got["terms"]] if got.num_rows else []
    at = np.concatenate(lists).astype(np.int64) if lists else np.zeros(0, np.int64)
    row = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    total = sum(counts.values())
    return fit(known, row, at, got["toxic"].to_numpy(), counts.get(1, 0) / total if total else 0.0)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each row of docs.

    Null text reads as empty (score of the intercept); repeated rows and null ids (never held out) get a result each;
    without labels every score is near 0; an empty table gives an empty result. Only the text enters a score.
    """
    model = train(docs, labels)

    def run(batches):
        for batch in batches:
            s = score(model, *vec.buffers(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s)], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs that score below the threshold, with their columns; no shuffle."""
    model = train(docs, labels)
    return filtered(docs, "text", lambda data, offsets: score(model, data, offsets) < THRESHOLD)
