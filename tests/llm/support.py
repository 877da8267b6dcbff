"""Small fixtures for the operators: planted copies, edge cases, clashing column names."""

import random

SYLLABLES = "the an re er on ti es in at ou nd st ha ed en or le".split()
CLASHING = ["gram", "fp", "pos", "row", "rows", "digest", "slot", "score", "length", "version", "line",
            "keep", "name", "s", "e", "n", "start", "rest", "raw", "cut", "spans", "label", "first_doc"]


def word(r):
    return "".join(r.choice(SYLLABLES) for _ in range(r.randint(1, 4)))


def prose(r, n):
    out = []
    while len(out) < n:
        k = r.randint(3, 12)
        out += [word(r) for _ in range(k - 1)] + [word(r) + r.choice([".", ",", ".\n"])]
    return " ".join(out[:n])


def corpus(seed=1, n=60):
    """(doc_id, text): prose with exact and near copies, shared lines and passages, edge cases."""
    r = random.Random(seed)
    docs = [[i, prose(r, r.randint(1, 160))] for i in range(n)]
    passage, line = prose(r, 70).replace("\n", " "), "This very line is everywhere in this table"
    for i in range(0, n, 5):
        a, b = docs[i][1].split(" "), r.randint(0, 3)
        docs[i][1] = " ".join(a[:b] + [passage] + a[b:])
    for i in range(0, n, 3):
        docs[i][1] += f"\n  {line.upper() if i % 2 else line}\t\nshort\n"
    for i in range(7, n, 11):
        docs[i][1] = docs[i - 4][1].replace(" ", "  ", 3)         # equal after normalising
    for i in range(8, n, 13):
        w = docs[i - 3][1].split(" ")
        w[len(w) // 2] = "changed"                                # a near copy
        docs[i][1] = " ".join(w)
    docs += [[n, None], [n + 1, ""], [n + 2, " \t\n\x0b\x0c\r "], [n + 3, "one"], [n + 4, "two Words"],
             [n + 5, "a\x00b é ü 日本 \u00a0x"], [n + 6, "x" * 700], [n + 7, prose(r, 9000)],
             [n + 8, "same row twice, with enough words to be a line of its own"],
             [n + 8, "same row twice, with enough words to be a line of its own"],
             [n + 9, "one id, text A, long enough line\nshared by both rows of it"],
             [n + 9, "one id, text B, long enough line\nshared by both rows of it"],
             [None, "a row without an id, and some words after it"],
             [n + 10, "İstanbul ΣΑΣ ẞ ſ don't WE'LL <|endoftext|> 12 345 ½"], [n + 11, "\n\n\n"]]
    return [tuple(d) for d in docs]


def frame(spark, docs, clashing=False):
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    if clashing:
        from pyspark.sql import functions as F
        df = df.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASHING)])
    return df
