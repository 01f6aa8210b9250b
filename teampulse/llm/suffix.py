"""Exact removal of repeated byte strings by sharded suffix arrays (operator 5).

A byte goes if a string of `LENGTH` bytes that covers it also starts earlier
(in a smaller doc_id, or before in its own document).

Sharding. Every string of LENGTH bytes (a window) belongs to its smallest hashed
run of `GRAM` bytes, the leftmost of equals (its anchor); equal windows have
equal anchors. Windows of one text with the same anchor are neighbours, about
35 of them. Only anchors that occur twice can hold repeats: their hashes are
counted in Spark, and for those alone the context, the bytes of the windows, is
sent to the shard of the anchor.

A shard builds an enhanced suffix array of its contexts: suffixes in order, with
the lengths of common prefixes. Suffixes whose first LENGTH bytes do not recur,
or recur only after one and the same byte (then the suffix one to the left
reports the repeat), are left out beforehand. A scan with a stack walks the tree
of common-prefix intervals of LENGTH bytes or more; an interval with diverse
left extensions is a maximal repeat group with all its occurrences. Each
occurrence but the earliest gives up as many bytes as it shares with an earlier
one. The spans of a document's contexts overlap and merge to whole passages.

Skew. Equal texts are aggregated by digest first: all copies but the first go
whole and no shard sees them. Equal contexts within a task's batch are sent once (the others are known
to be repeats of an earlier one). Contexts of an anchor with over `HOT_ANCHOR`
occurrences are sent as single windows, spread by the hash of the window, so
that what meets there is one equal string. A shard works through its rows in
order of the anchor, in chunks that end with an anchor.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401 - pa.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from teampulse.llm import vec
from teampulse.llm.frames import looked_up, partitions_for, stored

LENGTH = 100
GRAM = 32
HOT_ANCHOR = 20_000
#: Bytes of contexts that a shard takes at a time, at least one anchor's.
CHUNK_BYTES = 1 << 20
#: Contexts that a task compares before it sends them on.
COMBINED = 50_000
#: Texts longer than this are read in pieces.
PIECE_BYTES = 1 << 20
_PLACE = np.uint64((1 << 24) - 1)


def anchors(data, offsets, length: int = LENGTH, gram: int = GRAM):
    """(row, hash, first window, windows) of the runs of windows with one anchor, for texts of at most 2^24 bytes."""
    n = len(data)
    if n < length:
        z = np.zeros(0, np.int64)
        return z, z.astype(np.uint64), z, z
    total = vec.prefix_hash(data)
    h = vec.mix((total[gram:] - total[:-gram]) * vec.powers(n)[1][: n - gram + 1])
    low = (h & ~_PLACE) | np.arange(len(h), dtype=np.uint64)
    span, width = 1, length - gram + 1
    while span < width:  # smallest of `span` neighbours, doubled up to width
        step = min(span, width - span)
        low = np.minimum(low[: len(low) - step], low[step:])
        span += step
    starts = np.arange(len(low))
    row = np.searchsorted(offsets, starts, "right") - 1
    inside = starts + length <= offsets[row + 1]
    starts, row, owner = starts[inside], row[inside], (low[inside] & _PLACE).astype(np.int64)
    if not len(starts):
        z = np.zeros(0, np.int64)
        return z, z.astype(np.uint64), z, z
    new = np.ones(len(starts), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (row[1:] != row[:-1])
    at = np.flatnonzero(new)
    counts = np.diff(np.append(at, len(starts)))
    return row[at], h[owner[at]], starts[at] - offsets[row[at]], counts


def batch_anchors(data, offsets, length: int = LENGTH, gram: int = GRAM):
    """anchors() of the rows of any buffer."""
    found = []
    for i, j in vec.slices(offsets):
        low, high = int(offsets[i]), int(offsets[j])
        if high - low <= PIECE_BYTES:
            row, h, first, count = anchors(data[low:high], offsets[i : j + 1] - low, length, gram)
            found.append((row + i, h, first, count))
            continue
        for at in range(low, high, PIECE_BYTES):  # one long text: pieces share length - 1 bytes
            part = data[at : min(at + PIECE_BYTES + length - 1, high)]
            row, h, first, count = anchors(part, np.array([0, len(part)]), length, gram)
            found.append((row + i, h, first + at - low, count))
    if not found:
        return (np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))
    return tuple(np.concatenate(x) for x in zip(*found))


def maximal_repeats(lcp: np.ndarray, left: np.ndarray, length: int = LENGTH):
    """Intervals (depth, first, last) of an enhanced suffix array with diverse left extensions.

    lcp[i]: common prefix of suffixes i - 1 and i (lcp[0] = 0). left[i]: the byte before suffix i; a value over 255
    differs from all. Only depths of `length` or more; inner intervals come before outer ones.
    """
    stack: list[list] = []  # [depth, first, left byte or -1 if diverse]
    out = []
    n = len(lcp)
    for i in range(1, n + 1):
        depth = lcp[i] if i < n else 0
        first, byte = i - 1, left[i - 1]
        while stack and stack[-1][0] > depth:
            d, f, b = stack.pop()
            if b != byte or byte > 255:
                b = -1
            if b < 0:
                out.append((d, f, i - 1))
            first, byte = f, b
        if stack and stack[-1][0] == depth:
            top = stack[-1]
            if top[2] != byte or byte > 255:
                top[2] = -1
        elif depth >= length:
            stack.append([depth, first, byte if byte <= 255 else -1])
    return out


def resolve(groups, order_key):
    """(suffix, depth) of each occurrence that is not the earliest of its groups: the deepest group in which an earlier
    one occurs. groups: (depth, first, last), inner before outer; order_key[i]: rank of suffix i, smaller is earlier."""
    out, open_in = [], []  # open_in: (first, last, earliest) of the outermost groups so far, in order
    for depth, first, last in groups:
        inner = []
        while open_in and open_in[-1][0] >= first:
            inner.append(open_in.pop())
        members, at = [], first
        for f, l, e in reversed(inner):
            members += range(at, f)
            members.append(e)
            at = l + 1
        members += range(at, last + 1)
        earliest = min(members, key=order_key.__getitem__)
        out += [(m, depth) for m in members if m != earliest]
        open_in.append((first, last, earliest))
    return out


def repeated_spans(contexts: list[bytes], doc, place, length: int = LENGTH):
    """(context, begin, end) of the spans to remove: contexts[i] lies at place[i] of document doc[i]."""
    sizes = np.fromiter(map(len, contexts), np.int64, len(contexts))
    data = np.frombuffer(b"".join(contexts), np.uint8)
    base = np.cumsum(sizes) - sizes
    windows = sizes - length + 1
    own = np.repeat(np.arange(len(contexts)), windows)
    inner = np.arange(len(own)) - np.repeat(np.cumsum(windows) - windows, windows)
    at = base[own] + inner
    h = vec.span_hash(vec.prefix_hash(data), at, at + length)
    order = np.argsort(h)
    fresh = np.ones(len(order), bool)
    fresh[1:] = h[order[1:]] != h[order[:-1]]
    kind = np.cumsum(fresh) - 1
    begin = np.flatnonzero(fresh)
    left = np.where(inner == 0, 256, data[at - 1].astype(np.int64))[order]
    diverse = (np.maximum.reduceat(left, begin) != np.minimum.reduceat(left, begin)) | (np.maximum.reduceat(left, begin) > 255)
    take = (diverse & (np.diff(np.append(begin, len(order))) > 1))[kind]
    suffix, left, kind = order[take], left[take], kind[take]
    if not len(suffix):
        z = np.zeros(0, np.int64)
        return z, z, z
    # suffix array of what is left: by class of the first `length` bytes, then by the rest of the context
    own, inner, at = own[suffix], inner[suffix], at[suffix]
    size = sizes[own] - inner
    rest = int(size.max()) - length
    tail = np.zeros((len(suffix), 4 + rest + 1), np.uint8)
    tail[:, :4] = kind.astype(">u4").view(np.uint8).reshape(-1, 4)
    column = np.arange(rest)
    reach = np.minimum(at[:, None] + length + column, len(data) - 1)
    tail[:, 4:-1] = np.where(column < (size - length)[:, None], data[reach], 0)
    tail[:, -1] = size - length + 1  # of equal bytes the shorter suffix comes first
    rank = np.argsort(tail.view(f"S{tail.shape[1]}").ravel(), kind="stable")
    own, inner, at, size, left, tail = own[rank], inner[rank], at[rank], size[rank], left[rank], tail[rank]
    differs = tail[1:, :-1] != tail[:-1, :-1]
    common = np.where(differs.any(axis=1), differs.argmax(axis=1), differs.shape[1]) - 4
    lcp = np.zeros(len(at), np.int64)
    lcp[1:] = np.where(common < 0, 0, np.minimum(length + common, np.minimum(size[1:], size[:-1])))
    # equal hashes: the bytes themselves must agree
    near = np.flatnonzero(lcp)
    for part in np.array_split(near, max(1, len(near) // 20_000)):
        a = data[at[part][:, None] + np.arange(length)]
        b = data[at[part - 1][:, None] + np.arange(length)]
        lcp[part[(a != b).any(axis=1)]] = 0
    earlier = np.empty(len(at), np.int64)
    earlier[np.lexsort((place[own] + inner, doc[own]))] = np.arange(len(at))
    found = resolve(maximal_repeats(lcp.tolist(), left.tolist(), length), earlier.tolist())
    if not found:
        z = np.zeros(0, np.int64)
        return z, z, z
    which, depth = np.array(found).T
    return own[which], inner[which], inner[which] + depth


_ROW = "h long, w long, key long, place int, size int, context binary"
_FIELDS = ["h", "w", "key", "place", "size", "context"]


def _batch(h, w, doc, place, size, context):
    return pa.RecordBatch.from_arrays(
        [pa.array(h, pa.int64()), pa.array(w, pa.int64()), pa.array(doc, pa.int64()), pa.array(place, pa.int32()),
         pa.array(size, pa.int32()), pa.array(context, pa.binary())], _FIELDS)


def _anchor_hashes(length, gram):
    def run(batches):
        for batch in batches:
            h = batch_anchors(*vec.buffers(batch.column(0)), length, gram)[1]
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64))], ["h"])

    return run


def _anchor_rows(length, gram):
    def run(batches):
        for batch in batches:
            row, h, _, _ = batch_anchors(*vec.buffers(batch.column(1)), length, gram)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), batch.column(0).take(pa.array(row))], ["h", "key"])

    return run


def _among(row, h, lists) -> np.ndarray:
    """Whether lists[row] (an array column of hashes) has h."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    owner = np.repeat(np.arange(len(lists), dtype=np.uint64), np.diff(lists.offsets.to_numpy()))
    known = lists.flatten().to_numpy().view(np.uint64)
    pair = lambda r, x: vec.mix(x ^ vec.mix(r.astype(np.uint64) + np.uint64(1)))
    return np.isin(pair(row, h), pair(owner, known))


def _contexts(length, gram):
    """Rows (key, text, found, hot: arrays of anchor hashes that recur) to rows of _ROW: contexts, and spans (no context)
    of contexts that equal an earlier one of the batch. Anchors are found anew in the text, so none of their places
    had to be sent."""

    def run(batches):
        for batch in batches:
            kept: dict = {}
            spans = []
            data, offsets = vec.buffers(batch.column(1))
            row, h, first, count = batch_anchors(data, offsets, length, gram)
            is_hot = _among(row, h, batch.column(3))
            take = np.flatnonzero(is_hot | _among(row, h, batch.column(2)))
            raw, docs = data.tobytes(), batch.column(0).to_pylist()
            for r, anchor, place, n, hot, at in zip(
                    row[take].tolist(), h[take].view(np.int64).tolist(), first[take].tolist(), count[take].tolist(),
                    is_hot[take].tolist(), (offsets[row] + first)[take].tolist()):
                if hot:
                    part, inner = np.frombuffer(raw, np.uint8, n + length - 1, at), np.arange(n)
                    codes = vec.span_hash(vec.prefix_hash(part), inner, inner + length).view(np.int64).tolist()
                    parts = [(c, place + k, raw[at + k : at + k + length]) for k, c in enumerate(codes)]
                else:
                    parts = [(0, place, raw[at : at + n + length - 1])]
                for code, begin, context in parts:
                    key, mine = (anchor, code, context), (docs[r], begin)
                    other = kept.setdefault(key, mine)
                    if other != mine:
                        kept[key] = min(other, mine)
                        spans.append((*max(other, mine), len(context)))
                if len(kept) >= COMBINED:
                    yield from sent(kept, spans)
                    kept, spans = {}, []
            yield from sent(kept, spans)

    def sent(kept, spans):
        if kept:
            keys, places = zip(*kept.items())
            anchor, w, context = zip(*keys)
            doc, place = zip(*places)
            yield _batch(anchor, w, doc, place, list(map(len, context)), context)
        if spans:
            doc, place, size = zip(*spans)
            yield _batch(doc, place, doc, place, size, [None] * len(spans))  # spread over the shards

    return run


def _shards(length, chunk_bytes):
    """Rows of _ROW, sorted by (h, w), to spans (key, span = begin << 32 | end)."""

    def spans(doc, begin, end):
        return pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(begin << 32 | end, pa.int64())],
                                          ["key", "span"])

    def solve(rows):
        table = pa.Table.from_batches(rows)
        doc, place = (table[c].to_numpy().astype(np.int64) for c in ("key", "place"))
        which, begin, end = repeated_spans(table["context"].to_pylist(), doc, place, length)
        return spans(doc[which], place[which] + begin, place[which] + end)

    def run(batches):
        held, size = [], 0
        for batch in batches:
            ready = batch.filter(pa.compute.is_null(batch.column(5)))
            if ready.num_rows:
                place = ready.column(3).to_numpy().astype(np.int64)
                yield spans(ready.column(2), place, place + ready.column(4).to_numpy())
                batch = batch.filter(pa.compute.is_valid(batch.column(5)))
            if not batch.num_rows:
                continue
            h, w = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            turn = np.flatnonzero((h[1:] != h[:-1]) | (w[1:] != w[:-1])) + 1
            bytes_to = np.cumsum(batch.column(4).to_numpy())
            start = 0
            if held:
                last = held[-1]
                if (last.column(0)[-1].as_py(), last.column(1)[-1].as_py()) != (int(h[0]), int(w[0])):
                    turn = np.append(0, turn)
            for t in turn.tolist():  # flush before a new anchor once enough is held
                grown = size + int(bytes_to[t - 1] - (bytes_to[start - 1] if start else 0)) if t else size
                if grown >= chunk_bytes:
                    if t > start:
                        held.append(batch.slice(start, t - start))
                    yield solve(held)
                    held, size, start = [], 0, t
            held.append(batch.slice(start))
            size += int(bytes_to[-1] - (bytes_to[start - 1] if start else 0))
        if held:
            yield solve(held)

    return run


def _merged(spans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the union of spans (begin << 32 | end); spans that touch join."""
    spans = np.sort(spans)
    begin, end = spans >> 32, np.maximum.accumulate(spans & 0xFFFFFFFF)
    new = np.ones(len(spans), bool)
    new[1:] = begin[1:] > end[:-1]
    at = np.flatnonzero(new)
    return begin[at], end[np.append(at[1:] - 1, len(spans) - 1)] if len(at) else end[:0]


def cut(raw: bytes, spans) -> tuple[bytes, int]:
    """(bytes that stay, number of maximal runs removed)."""
    if not len(spans):
        return raw, 0
    begin, end = _merged(np.asarray(spans, np.int64))
    edges = [0, *np.stack([begin, end], axis=1).ravel().tolist(), len(raw)]
    return b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2])), len(begin)


_LOWEST = -(1 << 63)


def _texts(docs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """((key, text) of the documents; (id, tie, key) of their rows, or None where the key is the id).

    Keys follow the order of doc_id, null ids below all. Where ids are unique they are the keys. Else each distinct
    (id, text) is a document of its own, numbered in order of id and, within one, of a hash of the text.
    """
    n, distinct = docs.agg(F.count("*"), F.count_distinct("doc_id")).first()
    text = F.coalesce("text", F.lit(""))
    low = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_LOWEST).cast("bigint"))
    if n == distinct:
        return docs.select(low.alias("key"), text.alias("text")), None
    rows = docs.select(low.alias("id"), F.xxhash64(text).alias("tie"), text.alias("text"))
    numbers = stored(rows.select("id", "tie").distinct().orderBy("id", "tie")
                     .withColumn("key", F.monotonically_increasing_id()), "document-numbers")
    texts = rows.dropDuplicates(["id", "tie"]).join(numbers, ["id", "tie"]).select("key", "text")
    return texts, numbers


def _dealt(texts: DataFrame) -> DataFrame:
    """texts dealt out by key. Every step that needs the bytes reads this one exchange: its columns are never null, so no
    join adds a filter below it that would make it another."""
    return texts.repartition(partitions_for(texts), "key")


def _copies(texts: DataFrame, length: int) -> DataFrame:
    """(key, size) of the texts of `length` bytes or more that a smaller key has as well."""
    digests = stored(texts.select("key", F.octet_length("text").alias("size"), F.unhex(F.sha2("text", 256)).alias("digest")),
                     "text-digests")
    first = digests.groupBy("digest").agg(F.min("key").alias("first"), F.count("*").alias("n")).where(F.col("n") > 1)
    return (looked_up(digests, first, ["digest"], "n").where((F.col("key") > F.col("first")) & (F.col("size") >= length))
            .select("key", "size"))


def repeat_spans(texts: DataFrame, length: int = LENGTH, gram: int = GRAM, hot_anchor: int = HOT_ANCHOR,
                 chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(key, spans: array of begin << 32 | end) of the texts that lose bytes.

    Equal texts are aggregated first: all but the smallest key's go whole and stay out of the shards.
    """
    parts, copies = partitions_for(texts), _copies(texts, length)
    texts = _dealt(texts)
    rest = texts.join(copies, "key", "left").where(F.col("size").isNull()).select("key", "text")
    twice = stored(rest.select("text").mapInArrow(_anchor_hashes(length, gram), "h long").groupBy("h").count()
                   .where(F.col("count") > 1), "anchor-counts")
    twice = twice.select("h", (F.col("count") > hot_anchor).alias("hot"), F.col("count").alias("size"))
    found = (looked_up(rest.mapInArrow(_anchor_rows(length, gram), "h long, key long"), twice, ["h"], "size")
             .groupBy("key").agg(F.collect_list(F.when(~F.col("hot"), F.col("h"))).alias("found"),
                                 F.collect_list(F.when(F.col("hot"), F.col("h"))).alias("hot")))
    contexts = texts.join(found, "key").select("key", "text", "found", "hot").mapInArrow(_contexts(length, gram), _ROW)
    shards = contexts.repartition(parts, "h", "w").sortWithinPartitions("h", "w")
    spans = shards.mapInArrow(_shards(length, chunk_bytes), "key long, span long")
    whole = copies.select("key", F.col("size").cast("long").alias("span"))  # from 0 to size
    return spans.unionByName(whole).groupBy("key").agg(F.collect_list("span").alias("spans"))


def deduplicated(docs: DataFrame, with_kept: bool = False, **options) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of each row of docs, and the bytes kept if asked.

    Null text reads as empty. Null ids sort before all others. Rows that repeat an id and a text count as one document
    and have equal results; different texts of one id are ordered by a hash. An empty table gives an empty result.
    """
    texts, numbers = _texts(docs.select("doc_id", "text"))
    source = _dealt(texts).join(repeat_spans(texts, **options), "key", "left").select("key", "text", "spans")

    def run(batches):
        for batch in batches:
            out = []
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                raw = text.encode()
                kept, n = cut(raw, spans or ())
                out.append((len(raw), len(raw) - len(kept), n, hashlib.sha256(kept).hexdigest(), kept)[: len(names)])
            columns = list(zip(*out)) if out else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                                             ["key", *names])

    names = ["n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * with_kept
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
    results = source.mapInArrow(run, "key long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
                                + ", kept binary" * with_kept)
    if numbers is None:
        results = results.withColumnRenamed("key", "id")
    else:
        rows = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_LOWEST).cast("bigint")).alias("id"),
                           F.xxhash64(F.coalesce("text", F.lit(""))).alias("tie"))
        results = rows.join(numbers, ["id", "tie"]).join(results, "key")
    doc_id = F.when(F.col("id") != F.lit(_LOWEST).cast("bigint"), F.col("id")).cast(docs.schema["doc_id"].dataType)
    return results.select(doc_id.alias("doc_id"), *names)


def without_repeats(docs: DataFrame, **options) -> DataFrame:
    """docs with its columns, the repeats cut from the text; characters of which a byte goes are dropped whole, and
    n_chars, if docs has it, is counted anew. A null text stays null."""
    texts, numbers = _texts(docs.select("doc_id", "text"))
    spans = repeat_spans(texts, **options)
    low = F.coalesce(docs["doc_id"].cast("bigint"), F.lit(_LOWEST).cast("bigint"))
    if numbers is None:
        spans = spans.select(F.col("key").alias("_key"), F.col("spans").alias("_spans"))
        joined = docs.join(spans, low == spans["_key"], "left").drop("_key")
    else:
        spans = numbers.join(spans, "key").select(F.col("id").alias("_id"), F.col("tie").alias("_tie"), F.col("spans").alias("_spans"))
        tie = F.xxhash64(F.coalesce(docs["text"], F.lit("")))
        joined = docs.join(spans, (low == spans["_id"]) & (tie == spans["_tie"]), "left").drop("_id", "_tie")
    columns, names = docs.columns, joined.columns
    place, spans_at = names.index("text"), names.index("_spans")

    def run(batches):
        for batch in batches:
            all_spans = batch.column(spans_at).to_pylist()
            texts = [t if t is None or not s else cut(t.encode(), s)[0].decode(errors="ignore")
                     for t, s in zip(batch.column(place).to_pylist(), all_spans)]
            arrays = dict(zip(names, batch.columns))
            arrays["text"] = pa.array(texts, pa.string())
            if "n_chars" in columns:
                counts = [n if s is None or t is None else len(t)
                          for n, s, t in zip(arrays["n_chars"].to_pylist(), all_spans, texts)]
                arrays["n_chars"] = pa.array(counts, arrays["n_chars"].type)
            yield pa.RecordBatch.from_arrays([arrays[c] for c in columns], columns)

    return joined.mapInArrow(run, docs.schema)
