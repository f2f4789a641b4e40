"""Small tables with every awkward case, and brute-force versions of what the operators return."""

import re
from collections import defaultdict

from pyspark.sql import types as T

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = "".join(f"lang{i % 97} wort{i} {'é' * (i % 5)}\n" for i in range(9000))
PROSE = "the quick brown fox jumps over the lazy dog while seven wizards judge my vow of sphinx quartz under pale light"
ROWS = [
    (1, "a b  c"),
    (2, "a b\tc"),
    (2, "a b c"),
    (2, "a b c"),
    (None, "a b c"),
    (None, "nobody knows"),
    (3, None),
    (4, ""),
    (5, " \n "),
    (6, LONG),
    (7, LONG),
    (8, LONG + "ende"),
    (9, PROSE),
    (10, PROSE + " again"),
    (11, PROSE.replace("fox", "ox")),
    (12, "x" * 3000),
    (13, "mail me at jo.doe@mail.example.com or 10.20.30.40 or +1 (555) 010-0199 x 4111 1111 1111 1111"),
    (14, "<|endoftext|> twice <|endoftext|>  　 漢字 😀 é İ\x1c\x85"),
    (15, "PROSE " * 40),
]
#: Columns whose names an operator might use for itself.
CLASHES = ["_id", "_text", "size", "shard", "slot", "kind", "digest", "length", "sequence_id", "offset", "ids", "cls"]


def docs(spark, rows=ROWS):
    fields = [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())]
    fields += [T.StructField("lang", T.StringType()), T.StructField("source", T.StringType())]
    fields += [T.StructField("n_chars", T.LongType())] + [T.StructField(c, T.StringType()) for c in CLASHES]
    data = [(i, t, None, "host", len(t) if t else None, *("?" for _ in CLASHES)) for i, t in rows]
    return spark.createDataFrame(data, T.StructType(fields)).repartition(3)


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def shingles(text, n=5):
    words = WORD.findall(text or "")
    n = min(n, len(words))
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if words else frozenset()


def near_links(texts, threshold=0.8):
    """Partners of each text, by place."""
    sets = [shingles(t) for t in texts]
    holders = defaultdict(set)
    for i, s in enumerate(sets):
        for g in s:
            holders[g].add(i)
    out = [set() for _ in texts]
    for i, s in enumerate(sets):
        for j in set().union(*(holders[g] for g in s)) if s else ():
            common = len(s & sets[j])
            if i != j and common >= threshold * (len(s) + len(sets[j]) - common) - 1e-9:
                out[i].add(j)
    return out
