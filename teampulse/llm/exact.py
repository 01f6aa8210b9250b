"""Exact duplicates: rows grouped by a 128-bit content hash, their bytes compared inside the groups.

Only DataFrame functions. Texts are equal when they are identical after
lower-casing A-Z (a null text is empty). Three steps:

1. every row is reduced to its hash (MD5, 128 bits), the SHA-256 of its text, its id and a row number, and written
   below ``spark.checkpoint.dir``;
2. the texts of each hash are compared byte by byte, by a hash aggregate whose keys are hash and text: copies combine
   in the task that reads them, so a group with a third of all rows sends one text for each task. Two texts of one hash
   are two classes, told apart by their SHA-256; should two different texts agree in both digests, the job fails;
3. rows take up the facts of their class. Classes with over 1/1,024 of all rows, of which there are at most 1,023, are
   broadcast; rows of all others meet their class in an equi-join, in which no key holds more than 1/1,024 of the rows.

Defined results: a row without id counts in its group and stays only if no row of the group has one (``keep_id`` is
then null); of rows that repeat an id and a text exactly one stays; an empty table gives no rows; further columns play
no part, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from teampulse.llm.frames import stored

#: A class is hot when it holds more than one in so many rows.
HOT_SHARE = 1024
_EDGE = {"smallest": (1 << 63) - 1, "largest": -(1 << 63)}


def md5_128(text: Column) -> Column:
    return F.unhex(F.md5(text))


def folded(text: Column) -> Column:
    """A-Z lower-cased, all else as it is; null reads as empty."""
    return F.translate(F.coalesce(text, F.lit("")), ascii_uppercase, ascii_lowercase)


def _classes(rows: DataFrame, texts: DataFrame, keep: str) -> DataFrame:
    """One row per distinct text: h, sha, group_size, keep_id, keep_row; fails where two texts share both digests."""
    best, best_by = (F.max, F.max_by) if keep == "largest" else (F.min, F.min_by)
    both = rows.select("h", "sha", "id", "row", F.lit(1).alias("n"), F.lit(0).alias("texts")).unionByName(
        texts.select("h", F.unhex(F.sha2("text", 256)).alias("sha"), F.lit(None).cast("long").alias("id"),
                     F.lit(None).cast("long").alias("row"), F.lit(0).alias("n"), F.lit(1).alias("texts")))
    order = F.when(F.col("n") == 1, F.coalesce(F.col("id"), F.lit(_EDGE[keep])))
    found = both.groupBy("h", "sha").agg(F.sum("n").alias("n"), best("id").alias("keep_id"),
                                         best_by("row", order).alias("keep_row"), F.sum("texts").alias("texts"))
    return found.select("h", "sha", "keep_id", "keep_row", F.when(F.col("texts") == 1, F.col("n")).otherwise(
        F.raise_error(F.lit("two different texts share both digests"))).alias("group_size"))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, keep: str = "smallest",
                     digest: Callable[[Column], Column] = md5_128, whole_rows: bool = False) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256 (lowercase hex of the folded text) and,
    with ``whole_rows``, doc (struct of all columns). ``keep``: the row with the "smallest" or the "largest" id stays."""
    if keep not in _EDGE:
        raise ValueError("keep must be smallest or largest")
    place = {c: docs[c] for c in docs.columns}
    text = folded(place[text_col])
    hashed = docs.select(
        place[id_col].cast("long").alias("id"), digest(text).alias("h"), F.unhex(F.sha2(text, 256)).alias("sha"),
        F.monotonically_increasing_id().alias("row"),
        *([F.struct(*[place[c].alias(c) for c in docs.columns]).alias("doc")] if whole_rows else []))
    rows = stored(hashed, "exact-rows")
    texts = docs.select(text.alias("text")).select(digest(F.col("text")).alias("h"), "text").distinct()
    classes = stored(_classes(rows, texts, keep), "exact-classes")

    total = classes.agg(F.sum("group_size").alias("total"))
    hot = (classes.crossJoin(F.broadcast(total)).where(F.col("group_size") * HOT_SHARE > F.col("total"))
           .drop("total"))
    cold = classes.join(F.broadcast(hot.select("h", "sha")), ["h", "sha"], "left_anti")
    met = (rows.join(F.broadcast(hot), ["h", "sha"])
           .unionByName(rows.join(F.broadcast(hot.select("h", "sha")), ["h", "sha"], "left_anti").join(cold, ["h", "sha"])))
    return met.select("id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"),
                      F.lower(F.hex("sha")).alias("text_sha256"), *(["doc"] if whole_rows else []))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, keep: str = "smallest") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one of each class of equal texts."""
    out = exact_duplicates(docs, id_col, text_col, keep=keep, whole_rows=True)
    return out.where("kept").select("doc.*")
