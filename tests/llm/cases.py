"""Documents with nulls, empty and long texts, ties, repeats and near copies."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(n: int = 60, seed: int = 3):
    r = random.Random(seed)
    vocab = ["the", "of", "and", "is"] + ["".join(r.choices("abdeiklmnorstu", k=r.randint(2, 8))) for _ in range(400)]
    rows = []
    for i in range(n):
        words = r.choices(vocab, k=r.randint(1, 120))
        rows.append((i * 3, " ".join(words)))
        if i % 4 == 0:  # a near copy
            for _ in range(max(1, len(words) // 40)):
                words[r.randrange(len(words))] = "changed"
            rows.append((i * 3 + 1, " ".join(words)))
        if i % 7 == 0:
            rows.append((i * 3 + 2, rows[-1][1]))  # an exact copy
    rows += [
        (1000, None),
        (1001, ""),
        (1002, "  \n\t "),
        (1003, "word"),
        (1004, "Two words"),
        (1005, "%%% *** ."),
        (1006, " ".join(r.choices(vocab, k=6000))),
        (1007, "ÄÖÜ straße İstanbul ﬁne éte 　wide space, it's <|endoftext|> done."),
        (None, "a row without an id"),
        (1008, rows[0][1]),
        (1008, rows[0][1]),
    ]
    return [(i, t, "en", "src0", len(t or "")) for i, t in rows]


def frame(spark, rows=None, schema=SCHEMA, parts=4):
    return spark.createDataFrame(documents() if rows is None else rows, schema).repartition(parts)


def empty(spark, schema=SCHEMA):
    return spark.createDataFrame([], schema)
