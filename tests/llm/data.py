"""Small tables with the cases that every operator must bear."""

import random

KINDS = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, kept string, "
    "class string, doc string, digest string, bands string, id string, _id string, toxicity string, Text2 int"
)
LABELS = "doc_id bigint, quality int, toxic int"


def prose(seed, words, vocabulary=400):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}" for _ in range(words))


LONG = prose(1, 30_000)
TEXTS = [
    (1, "One two three four five six seven eight nine ten."),
    (2, "One two three four five six seven eight nine ten."),
    (2, "One two three four five six seven eight nine ten."),
    (3, None),
    (None, "a row without an id"),
    (None, None),
    (4, ""),
    (5, "   \n\t "),
    (6, LONG),
    (7, LONG + " and a little more"),
    (8, "two words"),
    (9, "É́tude naïve 中文 😀 <|endoftext|> tail"),
    (10, "line\nline\n\nline\n  spaced   out\tand\r\nended \n"),
    (11, prose(2, 120)),
    (12, prose(2, 120) + " x"),
    (13, "x" * 70_000),
    (14, prose(3, 4200, 50_000)),
]


def documents(spark, texts=TEXTS):
    rows = [(i, t, "en", None if i == 1 else f"s{(i or 0) % 3}", len(t or ""), *["?"] * 9, 0) for i, t in texts]
    return spark.createDataFrame(rows, KINDS).repartition(3)


def labels(spark, rows=((1, 1, 0), (11, 1, 0), (8, 0, 1), (8, 0, 0), (99, 1, 1), (None, 1, 1), (7, None, None))):
    return spark.createDataFrame(list(rows), LABELS)
