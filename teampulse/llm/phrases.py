"""Collocations: phrases that are frequent and hold together, counted over a prefix-free parse.

1. **Parse.** A piece of text (between punctuation or line ends) is cut where its own words say so: a chunk begins at
   the piece's first word and wherever the hash of the next ``MAX_WORDS - 1`` words is 0 modulo ``TRIGGER``. A chunk that
   goes on runs through these words of its successor, so every phrase lies whole in some chunk, and equal passages are
   cut alike wherever they stand. Tasks combine equal chunks; a chunk's hash says to which part of the dictionary it
   belongs. A part holds its distinct chunks with their parse frequencies and about ``PART_BYTES`` of input.
2. **Filter.** Each part counts the pairs of words in its chunks, weighted by the frequencies. A phrase counts where it
   starts, and in a chunk that goes on the words it shares with its successor start nothing, so overlaps count once. The
   pairs' hashes meet in a sum per hash; those that reach ``min_count`` go back to the parts that hold them. A collision
   of hashes can only let more through.
3. **Counts.** Each part counts its words, the pairs that passed, and the runs of three and four words all of whose pairs
   passed: no other can reach ``min_count``. These counts, with the words themselves, are summed per language and phrase
   and written below ``spark.checkpoint.dir``. Both readings of the dictionary use one exchange.
4. **Scores.** All in DataFrame functions, whole numbers up to 38 digits.

Defined results: a null text is empty; a null language is ``und``; rows that repeat count each time; without candidates,
or with an empty table, there are no rows; further columns play no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from teampulse.llm import vec
from teampulse.llm.frames import looked_up, partitions_for, stored

MAX_WORDS = 4
#: A chunk has this many words on average, where its piece is long enough.
TRIGGER = 32
#: Input bytes for each part of the dictionary.
PART_BYTES = 2 << 20
#: Chunk bytes that a task combines before it sends them on.
COMBINE_BYTES = 8 << 20
NO_LANGUAGE = "und"

PIECE_END = np.zeros(256, bool)
PIECE_END[[ord(c) for c in ".,;:!?"] + [0x0A, 0x0B, 0x0C, 0x0D]] = True
BETWEEN = PIECE_END.copy()
BETWEEN[[0x20, 0x09]] = True

_CHUNK = "lang string, chunk string, goes_on boolean, n long"


def _strings(data, starts, ends):
    """Arrow strings of the spans, which may overlap."""
    lengths = ends - starts
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(lengths, out=offsets[1:])
    bytes_ = data[np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], lengths)]
    return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(bytes_)).cast(pa.string())


def parse(data, offsets, trigger: int = TRIGGER):
    """Chunks of texts: their strings (words joined by one space), whether they go on, and the number of their text."""
    data = vec.LOWER[data]
    starts, ends, first = vec.words(data, offsets, BETWEEN)
    n = len(starts)
    marks = np.zeros(len(data) + 1, np.int64)
    np.cumsum(PIECE_END[data], out=marks[1:])
    begins = np.zeros(n, bool)
    begins[1:] = marks[starts[1:]] > marks[ends[:-1]]
    begins[first[:-1][first[:-1] < n]] = True
    piece = np.cumsum(begins)
    h = vec.span_hash(vec.prefix_hash(data), starts, ends)
    shared = MAX_WORDS - 1
    cuts = begins.copy()
    whole = max(n - shared + 1, 0)
    if whole:
        window = np.zeros(whole, vec.U64)
        for j in range(shared):
            window = vec.mix(window + h[j:j + whole])
        cuts[:whole] |= (window % vec.U64(trigger) == 0) & (piece[:whole] == piece[shared - 1:])
    at = np.flatnonzero(cuts)
    after = np.append(at[1:], n)
    goes_on = np.append(piece[at[1:]] == piece[at[:-1]], False) if len(at) else np.zeros(0, bool)
    joined, starts, ends = vec.normalised(data, starts, ends)
    last = after - 1 + np.where(goes_on, shared, 0)
    text = np.searchsorted(first, at, "right") - 1
    return _strings(joined, starts[at], ends[last]), goes_on, text


def _combined(batches):
    """One batch with equal chunks added up."""
    total = pa.Table.from_batches(batches).group_by(["lang", "chunk", "goes_on"], use_threads=False).aggregate([("n", "sum")])
    return total.rename_columns([c.removesuffix("_sum") for c in total.column_names]).select(["lang", "chunk", "goes_on", "n"])


def parsed(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", trigger: int = TRIGGER) -> DataFrame:
    """(lang, chunk, goes_on, n): the parse of all texts; a chunk may come in several rows, whose n add up."""

    def run(batches):
        held, size = [], 0
        for batch in batches:
            data, offsets = vec.buffers(batch.column(1))
            for i, j in vec.slices(offsets):
                chunk, goes_on, text = parse(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], trigger)
                if not len(chunk):
                    continue
                lang = batch.column(0).take(pa.array(i + text))
                held.append(pa.RecordBatch.from_arrays(
                    [lang, chunk, pa.array(goes_on), pa.array(np.ones(len(text), np.int64))],
                    names=["lang", "chunk", "goes_on", "n"]))
                size += held[-1].nbytes
                if size > COMBINE_BYTES:
                    yield from _combined(held).to_batches(max_chunksize=20_000)
                    held, size = [], 0
        if held:
            yield from _combined(held).to_batches(max_chunksize=20_000)

    rows = docs.select(F.coalesce(docs[lang_col], F.lit(NO_LANGUAGE)).alias("lang"), docs[text_col].alias("text"))
    return rows.mapInArrow(run, _CHUNK)


class _Part:
    """The distinct chunks of a part, word by word.

    code: each word's number in ``words``; chunk: the chunk of each word; left: words from here to the chunk's end;
    starts: whether phrases that start here count for this chunk; weight: the chunk's frequency; lang: its language."""

    def __init__(self, table):
        table = _combined(table.select(["lang", "chunk", "goes_on", "n"]).to_batches())
        languages = table.column("lang").combine_chunks().dictionary_encode()
        data, offsets = vec.buffers(table.column("chunk"))
        begin, end, first = vec.words(data, offsets, BETWEEN)
        counts = np.diff(first)
        words = _strings(data, begin, end).dictionary_encode()
        self.languages, self.words = languages.dictionary, words.dictionary
        self.code = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.chunk = np.repeat(np.arange(len(counts)), counts)
        self.left = np.repeat(first[1:], counts) - np.arange(len(begin))
        goes_on = table.column("goes_on").to_numpy()
        self.starts = self.left >= np.where(goes_on, MAX_WORDS, 1)[self.chunk]
        self.weight = table.column("n").to_numpy()
        self.lang = languages.indices.to_numpy(zero_copy_only=False).astype(np.int64)

    def distinct(self, at, keys):
        """The different keys of the places `at`: (number of each place's key, a place for each key, its frequency)."""
        _, place, number = np.unique(keys, return_index=True, return_inverse=True)
        total = np.zeros(len(place), np.int64)
        np.add.at(total, number, np.where(self.starts[at], self.weight[self.chunk[at]], 0))
        return number, at[place], total

    def longer(self, at, number, k):
        """Keys of the runs of k words at `at` from the numbers of those of k - 1 words."""
        return number * max(len(self.words), 1) + self.code[at + k - 1]

    def singles(self, at):
        return self.lang[self.chunk[at]] * max(len(self.words), 1) + self.code[at]

    def pair_hash(self, place):
        """A hash of language and pair at each place that is the same in every part."""
        def of(strings):
            data, offsets = vec.buffers(strings)
            return vec.span_hash(vec.prefix_hash(data), offsets[:-1], offsets[1:])

        word, lang = of(self.words), of(self.languages)
        h = vec.mix(word[self.code[place]] + vec.U64(1)) + lang[self.lang[self.chunk[place]]]
        return vec.mix(vec.mix(h) + word[self.code[place + 1]]).view(np.int64)

    def phrase(self, place, k):
        """Arrow columns lang and phrase of the runs of k words at each place."""
        import pyarrow.compute as pc

        words = [self.words.take(pa.array(self.code[place + j])) for j in range(k)]
        text = pc.binary_join_element_wise(*words, " ") if k > 1 else words[0]
        return self.languages.take(pa.array(self.lang[self.chunk[place]])), text


def _pairs(part):
    """(number of each pair's key, a place for each key, its frequency, places) of all pairs of a part. Those that stand
    only where a chunk goes on have frequency 0 here: their successors count them, longer phrases here ask for them."""
    at = np.arange(len(part.code))
    number, _, _ = part.distinct(at, part.singles(at))
    two = part.left >= 2
    at, number = at[two], number[two]
    return (*part.distinct(at, part.longer(at, number, 2)), at)


def _pair_counts(key, table):
    part = _Part(table)
    _, place, total, _ = _pairs(part)
    return pa.table({"h": pa.array(part.pair_hash(place)), "part": pa.array(np.full(len(place), key[0].as_py(), np.int64)),
                     "n": pa.array(total)})


def _phrase_counts(key, table, passed):
    out = []

    def add(place, k, total):
        lang, text = part.phrase(place, k)
        out.append(pa.table({"lang": lang, "phrase": text, "size": pa.array(np.full(len(place), k, np.int64)),
                             "n": pa.array(total)}))

    if table.num_rows:
        part = _Part(table)
        at = np.flatnonzero(part.starts)
        _, place, total = part.distinct(at, part.singles(at))
        add(place, 1, total)
        in_lang = np.zeros(len(part.languages), np.int64)
        np.add.at(in_lang, part.lang[part.chunk[at]], part.weight[part.chunk[at]])
        out.append(pa.table({"lang": part.languages, "phrase": pa.array([""] * len(in_lang)),
                             "size": pa.array(np.zeros(len(in_lang), np.int64)), "n": pa.array(in_lang)}))
        number, place, total, at = _pairs(part)
        ok = np.isin(part.pair_hash(place), passed.column("h").to_numpy())
        counted = ok & (total > 0)
        add(place[counted], 2, total[counted])
        good = np.zeros(len(part.code) + 1, bool)
        good[at] = ok[number]
        at, number = at[part.starts[at]], number[part.starts[at]]
        for k in range(3, MAX_WORDS + 1):
            go = good[at] & good[at + k - 2] & (part.left[at] >= k)
            at, number = at[go], number[go]
            if not len(at):
                break
            number, place, total = part.distinct(at, part.longer(at, number, k))
            add(place, k, total)
    if not out:
        return pa.table({"lang": pa.array([], pa.string()), "phrase": pa.array([], pa.string()),
                         "size": pa.array([], pa.int64()), "n": pa.array([], pa.int64())})
    return pa.concat_tables(out)


def phrase_counts(docs: DataFrame, min_count: int, text_col: str = "text", lang_col: str = "lang",
                  trigger: int = TRIGGER, part_bytes: int = PART_BYTES) -> DataFrame:
    """(lang, phrase, size, n): all phrases of up to ``MAX_WORDS`` words with n >= ``min_count``, and with size 0 and an
    empty phrase the number of words of each language."""
    parts = partitions_for(docs, part_bytes, floor=1)
    chunks = parsed(docs, text_col, lang_col, trigger).withColumn("part", F.pmod(F.xxhash64("lang", "chunk"), F.lit(parts)))
    pairs = chunks.groupBy("part").applyInArrow(_pair_counts, "h long, part long, n long")
    passed = (pairs.withColumn("total", F.sum("n").over(Window.partitionBy("h")))
              .where(F.col("total") >= min_count).select("part", "h"))
    counts = (chunks.groupBy("part").cogroup(passed.groupBy("part"))
              .applyInArrow(_phrase_counts, "lang string, phrase string, size long, n long"))
    return counts.groupBy("lang", "phrase", "size").agg(F.sum("n").alias("n")).where(
        (F.col("n") >= min_count) | (F.col("size") == 0))


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", *, min_count: int = 30, top: int = 2000,
                 cover_percent: int = 80, trigger: int = TRIGGER, part_bytes: int = PART_BYTES) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``top`` phrases of two to ``MAX_WORDS`` words.

    a: the phrase's occurrences; l, r: those of the two parts of its worst cut, whose score floor(2000000 * a / (l + r))
    is the phrase's; n: the words of the language. A phrase inside a longer one with at least ``cover_percent`` of its
    occurrences is left out."""
    counts = stored(phrase_counts(docs, min_count, text_col, lang_col, trigger, part_bytes), "phrase-counts")
    f = counts.where(F.col("size") > 0)
    many = f.where(F.col("size") >= 2)
    words = F.split("phrase", " ")

    def run(start, length):
        return F.array_join(F.slice(words, start, length), " ")

    # both parts of a cut are frequent, as they occur wherever the phrase does; each looks up its count
    k, size = F.col("k"), F.col("size")
    cut = many.select("lang", "phrase", "size", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), (size - 1).cast("int"))).alias("k"))
    parts = stored(cut.select("lang", "phrase", "a", "k", F.explode(F.array(
        F.struct(F.lit(True).alias("head"), run(F.lit(1), k).alias("part")),
        F.struct(F.lit(False).alias("head"), run(k + 1, (size - k).cast("int")).alias("part")))).alias("p")).select(
        "lang", "phrase", "a", "k", "p.head", "p.part"), "phrase-cuts")
    found = looked_up(parts, f.select("lang", F.col("phrase").alias("part"), F.col("n").alias("m")), ["lang", "part"])
    cut = found.groupBy("lang", "phrase", "k").agg(F.max("a").alias("a"), F.max(F.when(F.col("head"), F.col("m"))).alias("l"),
                                                   F.max(F.when(~F.col("head"), F.col("m"))).alias("r"))
    a, both = F.col("a").cast("decimal(19,0)"), F.col("l").cast("decimal(19,0)") + F.col("r").cast("decimal(19,0)")
    scaled = (F.lit(2000000).cast("decimal(7,0)") * a)
    cut = cut.withColumn("score", ((scaled - scaled % both) / both).cast("long"))
    worst = cut.groupBy("lang", "phrase").agg(F.max("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    # what the longer phrases around a phrase have at most: one row per part of a phrase, combined before the exchange
    spans = F.expr("flatten(transform(sequence(2, cast(size - 1 AS int)), k -> transform(sequence(1, cast(size - k + 1 AS int)), "
                   "s -> array_join(slice(split(phrase, ' '), s, k), ' '))))")
    inside = (many.where(F.col("size") >= 3).select("lang", F.explode(spans).alias("phrase"), "n")
              .groupBy("lang", "phrase").agg(F.max("n").alias("longer")))
    big = F.lit(100).cast("decimal(3,0)") * F.col("longer").cast("decimal(19,0)")
    kept = (worst.join(inside, ["lang", "phrase"], "left")
            .where(F.col("longer").isNull() | (big < F.lit(cover_percent).cast("decimal(3,0)") * F.col("a").cast("decimal(19,0)")))
            .select("lang", "phrase", "a", "cut.score", "cut.l", "cut.r"))

    # the first `top` of each of 64 shares of a language, then of the language
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    share = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(64))).orderBy(*order)
    first = kept.withColumn("rank", F.row_number().over(share)).where(F.col("rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    total = counts.where(F.col("size") == 0).select("lang", F.col("n"))
    return ranked.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
