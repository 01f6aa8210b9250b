"""Quality rules with an isolation forest (operator 1).

Rules count words, symbols, capitals, repeated lines, words said twice in a row
and repeated 8-word windows of a whole text. Their ratios are the statistics of an isolation forest: trees of
random splits, each grown on `SAMPLE` rows; a row that few splits isolate is
anomalous, score 2^(-mean path length / c(SAMPLE)).

The forest is fitted on a bounded sample, `TREES * SAMPLE` labelled rows of
good quality (rows of any kind where there are no labels), chosen by a hash of
the id; its splits are drawn over the ranges of all documents. The threshold is calibrated on all labelled rows: from the histogram of
their scores by label (`SCORE_STEPS` cells) the cut is taken that rejects the
largest share of bad rows less `COST` times that of good ones.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from teampulse.llm import vec
from teampulse.llm.frames import stored

TREES = 128
SAMPLE = 256
SCORE_STEPS = 2000
COST = 50.0
WINDOW = 8
MIN_WORDS = 20
#: Threshold where no row is labelled: the usual mark of a clear anomaly.
UNCALIBRATED = 0.7

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
EXTRA = ["n_lines", "n_same_words", "n_upper", "n_letters"]
_SYMBOL = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
_LEAD = (np.arange(256) & 0xC0) != 0x80


def _repeated_words(ids: np.ndarray, window: int = WINDOW) -> int:
    """Words in windows that occur twice or more. ids: equal for equal words only."""
    n = len(ids) - window + 1
    if n < 2:
        return 0
    code = vec.seeded(window, 5) | np.uint64(1)
    h = np.zeros(n, np.uint64)
    for j in range(window):
        h += vec.mix(ids[j : j + n] + code[j]) * code[j]
    order = np.argsort(h, kind="stable")
    same = h[order][1:] == h[order][:-1]
    if not same.any():
        return 0
    # equal hashes: compare the windows themselves
    view = np.lib.stride_tricks.sliding_window_view(ids, window)
    seen, found = {}, np.zeros(n, bool)
    tied = np.zeros(n, bool)
    tied[1:] |= same
    tied[:-1] |= same
    for i in np.sort(order[tied]).tolist():
        first = seen.setdefault(view[i].tobytes(), i)
        if first != i:
            found[first] = found[i] = True
    cover = np.zeros(len(ids) + 1, np.int64)
    at = np.flatnonzero(found)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + window, -1)
    return int((np.cumsum(cover) > 0).sum())


def _exact_ids(data, starts, ends, hashes) -> np.ndarray:
    """Numbers of words, equal for equal bytes only (hashes that meet by chance are told apart)."""
    unique, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
    a, b = starts[first][inverse], ends[first][inverse]
    if (ends - starts != b - a).any():
        return _slow_ids(data, starts, ends)
    lengths = ends - starts
    own = np.flatnonzero(np.repeat(np.ones(len(lengths), bool), lengths) if len(lengths) else [])
    shift = np.repeat(a - starts, lengths)
    begin = np.cumsum(lengths) - lengths
    place = own - np.repeat(begin, lengths) + np.repeat(starts, lengths)
    if (data[place] != data[place + shift]).any():
        return _slow_ids(data, starts, ends)
    return inverse.astype(np.uint64)


def _slow_ids(data, starts, ends):
    raw, seen = data.tobytes(), {}
    return np.array([seen.setdefault(raw[a:b], len(seen)) for a, b in zip(starts, ends)], np.uint64)


def rule_counts(data, offsets) -> dict[str, np.ndarray]:
    """The counts of COUNTS and EXTRA for each row of a byte buffer."""
    rows = len(offsets) - 1
    out = {c: np.zeros(rows, np.int64) for c in COUNTS + EXTRA}
    for i, j in vec.slices(offsets):
        offs, piece = offsets[i : j + 1] - offsets[i], data[offsets[i] : offsets[j]]
        starts, ends, first = vec.words(piece, offs)
        upto = lambda flags: np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        per_row = lambda total: total[offs[1:]] - total[offs[:-1]]
        out["n_words"][i:j] = np.diff(first)
        out["word_chars"][i:j] = per_row(upto(_LEAD[piece] & ~vec.SPACE[piece]))
        out["n_symbols"][i:j] = per_row(upto(_SYMBOL[piece]))
        out["n_upper"][i:j] = per_row(upto((piece >= 65) & (piece <= 90)))
        out["n_letters"][i:j] = per_row(upto((((piece | 32) >= 97) & ((piece | 32) <= 122))))
        if not len(starts):
            continue
        total = vec.prefix_hash(piece)
        ids = _exact_ids(piece, starts, ends, vec.span_hash(total, starts, ends))
        same = np.zeros(len(ids), bool)  # equal to the word before it in the text
        same[1:] = ids[1:] == ids[:-1]
        same[first[:-1][first[:-1] < len(ids)]] = False
        same = upto(same)
        out["n_same_words"][i:j] = same[first[1:]] - same[first[:-1]]
        raw = piece.tobytes()
        for r in range(j - i):
            a, b = first[r], first[r + 1]
            if b > a:
                out["n_repeat_words"][i + r] = _repeated_words(ids[a:b])
                lines = [x for x in raw[offs[r] : offs[r + 1]].split(b"\n") if x.strip(b" \t\n\x0b\x0c\r")]
                out["n_lines"][i + r] = len(lines)
                out["n_dup_lines"][i + r] = len(lines) - len(set(lines))
    return out


def base_failed(counts) -> np.ndarray:
    n = counts["n_words"]
    return (n < MIN_WORDS) | (100 * counts["n_repeat_words"] > 30 * n)


def statistics(c) -> np.ndarray:
    """Ratios, one row each: none grows with the length of the text. Few symbols count for much, one repeated line of a
    short text for little."""
    n = np.maximum(c["n_words"], 1)
    return np.stack([
        np.log1p(20 * c["n_symbols"] / n),
        c["n_repeat_words"] / n,
        c["n_dup_lines"] / (c["n_lines"] + 4),
        c["n_same_words"] / n,
        c["n_upper"] / np.maximum(c["n_letters"], 1),
        np.log1p(c["word_chars"] / n),
    ], axis=1)


def path_constant(n) -> float:
    """Mean path length of an unsuccessful search in a binary tree of n rows."""
    return 0.0 if n < 2 else 2 * (np.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n


def grow(x: np.ndarray, low, high, rng, limit: int) -> np.ndarray:
    """One tree as rows (feature or -1, cut, left, right, path length at a leaf).

    Cuts are uniform over the box [low, high] that the splits above left, not only over the rows in it: regions
    where no fitted row lies become leaves of their own, near the root if they are wide.
    """
    nodes = []

    def split(rows, low, high, depth):
        me = len(nodes)
        nodes.append([-1, 0.0, 0, 0, depth + path_constant(len(rows))])
        wide = np.flatnonzero(high > low)
        if depth < limit and len(rows) > 1 and len(wide):
            f = int(rng.choice(wide))
            cut = rng.uniform(low[f], high[f])
            left = rows[:, f] < cut
            below, above = high.copy(), low.copy()
            below[f] = above[f] = cut
            nodes[me][:4] = [f, cut, split(rows[left], low, below, depth + 1), split(rows[~left], above, high, depth + 1)]
        return me

    split(x, low, high, 0)
    return np.array(nodes, float)


def fit(x: np.ndarray, low, high, trees: int = TREES, sample: int = SAMPLE, seed: int = 1) -> dict:
    """A forest on rows x, with splits over the box [low, high] of the whole corpus."""
    rng = np.random.default_rng(seed)
    size = min(sample, len(x))
    limit = int(np.ceil(np.log2(max(size, 2)))) + 4
    low, high = np.asarray(low, float), np.asarray(high, float)
    grown = [grow(x[rng.choice(len(x), size, replace=False)], low, high, rng, limit) for _ in range(trees if size else 0)]
    return {"trees": grown, "size": size}


def score(forest: dict, x: np.ndarray) -> np.ndarray:
    """Anomaly scores, 0 to 1; 0.5 everywhere for an empty forest."""
    if not forest["trees"] or not len(x):
        return np.full(len(x), 0.5)
    total = np.zeros(len(x))
    for tree in forest["trees"]:
        feature, cut = tree[:, 0].astype(np.int64), tree[:, 1]
        child = tree[:, 2:4].astype(np.int64)
        node = np.zeros(len(x), np.int64)
        active = np.flatnonzero(feature[node] >= 0)
        while len(active):
            f = feature[node[active]]
            right = (x[active, f] >= cut[node[active]]).astype(np.int64)
            node[active] = child[node[active], right]
            active = active[feature[node[active]] >= 0]
        total += tree[node, 4]
    return 2.0 ** (-(total / len(forest["trees"])) / max(path_constant(forest["size"]), 1e-9))


def _with_counts(docs: DataFrame) -> DataFrame:
    """(id, counts) of each row."""
    source = docs.select(F.col("doc_id").alias("id"), F.col("text").alias("text"))
    names = COUNTS + EXTRA

    def run(batches):
        for batch in batches:
            counts = rule_counts(*vec.buffers(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(counts[c], pa.int64()) for c in names)],
                                             ["id", *names])

    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(run, f"id {kind}, " + ", ".join(f"{c} long" for c in names))


def _beside_counts(docs: DataFrame) -> DataFrame:
    """(doc: struct of the row's columns, id, counts) of each row; only the texts go to the Python workers."""
    names = COUNTS + EXTRA

    @F.arrow_udf(T.StructType([T.StructField(c, T.LongType()) for c in names]))
    def counts(text: pa.Array) -> pa.Array:
        found = rule_counts(*vec.buffers(text))
        return pa.StructArray.from_arrays([pa.array(found[c], pa.int64()) for c in names], names)

    return docs.select(F.struct(*docs.columns).alias("doc"), F.col("doc_id").alias("id"), counts("text").alias("counts")).select(
        "doc", "id", "counts.*")


def _scored(counted: DataFrame, forest: dict) -> DataFrame:
    """counted with base_failed and anomaly."""
    names = COUNTS + EXTRA

    def run(batches):
        for batch in batches:
            counts = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in names}
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(base_failed(counts)), pa.array(score(forest, statistics(counts)))],
                [*batch.schema.names, "base_failed", "anomaly"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in counted.schema)
    return counted.mapInArrow(run, schema + ", base_failed boolean, anomaly double")


def _ranges(counted: DataFrame):
    """Smallest and largest statistics of the corpus (a row for each task reaches the driver)."""

    def run(batches):
        low = high = None
        for batch in batches:
            if batch.num_rows:
                x = statistics({c: batch.column(c).to_numpy(zero_copy_only=False) for c in COUNTS + EXTRA})
                low = x.min(axis=0) if low is None else np.minimum(low, x.min(axis=0))
                high = x.max(axis=0) if high is None else np.maximum(high, x.max(axis=0))
        if low is not None:
            n = np.arange(len(low))
            yield pa.RecordBatch.from_arrays([pa.array(n, pa.int64()), pa.array(low), pa.array(high)], ["f", "low", "high"])

    rows = (counted.mapInArrow(run, "f long, low double, high double").groupBy("f")
            .agg(F.min("low"), F.max("high")).orderBy("f").collect())
    return [r[1] for r in rows], [r[2] for r in rows]


def train(docs: DataFrame, labels: DataFrame, counted: DataFrame) -> tuple[dict, float]:
    """(forest, threshold) for `counted`, the rule counts of docs."""
    quality = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy("doc_id").agg(
        F.min("quality").alias("good"))
    sane = counted.where((F.col("n_words") >= MIN_WORDS) & (100 * F.col("n_repeat_words") <= 30 * F.col("n_words")))
    labelled = sane.join(quality, sane["id"] == quality["doc_id"]).drop("doc_id")
    bound = TREES * SAMPLE

    def sample(rows):
        """The `bound` rows with the smallest hashes. A cut of the hashes that leaves a quarter more comes first, so that
        tasks sort and send about as many rows as are wanted, however many there are."""
        n = rows.count()
        every = (1 << 64) - 1
        h, cut = F.xxhash64("id"), -(1 << 63) + min(every, 5 * bound * every // (4 * max(n, 1)))
        few = rows.where(h <= F.lit(cut))
        if few.count() < min(bound, n):  # many rows share an id, and with it a hash
            few = rows
        return few.orderBy(h, "id", *COUNTS).limit(bound).select(*COUNTS, *EXTRA).toPandas()

    rows = sample(labelled.where(F.col("good") == 1))
    if not len(rows):
        rows = sample(sane)
    low, high = _ranges(counted)
    forest = fit(statistics({c: rows[c].to_numpy() for c in COUNTS + EXTRA}), low, high)
    cells = (_scored(labelled, forest).groupBy(F.floor(F.col("anomaly") * SCORE_STEPS).cast("int").alias("cell"), "good")
             .count().collect())
    return forest, threshold(cells)


def threshold(cells) -> float:
    """The cut with the largest (share of bad rows at or above it) - COST * (share of good rows at or above it).

    cells: (cell, good, count). 1.0 (nothing is rejected) if no cut gains; UNCALIBRATED without labels of both kinds.
    """
    bad, good = np.zeros(SCORE_STEPS + 1), np.zeros(SCORE_STEPS + 1)
    for cell, is_good, n in cells:
        (good if is_good else bad)[min(cell, SCORE_STEPS)] += n
    if not bad.sum() or not good.sum():
        return UNCALIBRATED
    above = lambda x: np.cumsum(x[::-1])[::-1] / x.sum()
    gain = above(bad) - COST * above(good)
    best = int(np.argmax(gain))
    return best / SCORE_STEPS if gain[best] > 0 else 1.01


def quality_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(id, counts, base_failed, anomaly, kept) of each row of docs.

    Null text reads as empty (fails the base rule); repeated rows and null ids get a result each; an empty table gives
    an empty result. Labels are matched by doc_id; a document labelled both ways counts as bad.
    """
    counted = stored(_with_counts(docs), "rule-counts")
    forest, cut = train(docs, labels, counted)
    return _scored(counted, forest).withColumn("kept", ~F.col("base_failed") & (F.col("anomaly") < F.lit(cut)))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs that pass the base rule and the forest, with their columns. Rules are counted once, and written
    beside the rows; judged row by row, no shuffle."""
    counted = stored(_beside_counts(docs), "rule-counts")
    forest, cut = train(docs, labels, counted.drop("doc"))

    names = COUNTS + EXTRA

    @F.arrow_udf(T.BooleanType())
    def good(*columns: pa.Array) -> pa.Array:
        counts = {c: x.to_numpy(zero_copy_only=False) for c, x in zip(names, columns)}
        return pa.array(~base_failed(counts) & (score(forest, statistics(counts)) < cut), pa.bool_())

    return counted.where(good(*names)).select("doc.*")
