"""Small tables with every awkward case, and plain reference computations."""

import re

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
PARAGRAPH = ("The committee met on Tuesday to discuss the northern railway, its bridges and the cost of keeping "
             "twelve small stations open through the winter months. ")
LONG = " ".join(f"word{i % 977} and{i % 31}" for i in range(9000))

TEXTS = [
    (0, PARAGRAPH * 2 + "It ended at noon."),
    (1, "Short text."),
    (2, ""),
    (3, None),
    (4, PARAGRAPH * 2 + "It ended at noon."),  # exact copy
    (5, "  \n\t "),
    (6, "Grüße aus Köln — naïve café, 東京 2024! " * 8),
    (7, LONG),
    (8, "aaaa" * 200),
    (9, "Intro words here. " + PARAGRAPH + " Outro words there, all of them new and different."),
    (10, "one two three\none two three\none two three\n" * 6),
    (11, LONG + " tail"),
    (12, "\x00nul \x7f\x1cbytes\x0b here " + PARAGRAPH),
]

#: Extra columns named like columns that the operators add or use inside.
CLASHES = ["id", "key", "fp", "score", "kept", "spans", "terms", "h", "bucket", "size", "mask", "target", "host"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHES)


def documents(spark, rows=TEXTS, more=()):
    data = [(i, t, "en" if t else None, None, None if t is None else len(t), *[None] * len(CLASHES)) for i, t in [*rows, *more]]
    return spark.createDataFrame(data, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def simhash(text, k=4):
    words = WORD.findall((text or "").translate(LOWER))
    runs = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(values, linked):
    """Index of the first member of each value's class."""
    parent = list(range(len(values)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(values)):
        for j in range(i):
            if linked(values[i], values[j]):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(values))]


def repeats(texts, length=100):
    """Flags of the bytes of each text (in order) that a string which also starts earlier covers."""
    seen, out = set(), []
    for raw in texts:
        gone = np.zeros(len(raw), bool)
        for s in range(len(raw) - length + 1):
            window = raw[s : s + length]
            if window in seen:
                gone[s : s + length] = True
            seen.add(window)
        out.append(gone)
    return out
