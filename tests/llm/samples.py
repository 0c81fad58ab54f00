"""Small tables with everything that operators must bear."""

import random

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns with names that operators use themselves.
EXTRA = ["row", "_row", "_text", "_id", "_key", "_held", "score", "token", "node", "kind", "start", "n", "run", "label", "item"]


def prose(rng, words, vocabulary=400):
    """Sentences of about ten invented words."""
    out = []
    for k in range(words):
        word = "".join(rng.choice(["an", "to", "re", "lo", "mi", "ka", "é"]) for _ in range(1 + rng.randrange(vocabulary) % 4))
        out.append(word + str(rng.randrange(vocabulary)).translate(str.maketrans("0123456789", "abcdefghij")))
        if rng.random() < 0.1:
            out[-1] += rng.choice([".", ".", ".\n", "!"])
    return " ".join(out)


def messy_texts(rng):
    """(doc_id, text): nulls, empty and blank texts, a very long one, repeated rows, copies and ties."""
    passage = prose(rng, 80)
    same = prose(rng, 120)
    return [
        (None, None),
        (None, same),
        (1, None),
        (2, ""),
        (3, " \n\t \n"),
        (4, prose(rng, 20_000)),
        (5, same),
        (5, same),
        (6, same),
        (7, same + " one more word"),
        (8, prose(rng, 60) + "\n" + passage + "\n" + prose(rng, 60)),
        (9, prose(rng, 70) + "\n" + passage),
        (10, "word"),
        (11, "word"),
        (12, "Ünïcödé 日本 🙂 ​ \x00 <|endoftext|> it's"),
        (13, "ha " * 500),
    ]


def documents(spark, texts, extra=True):
    """The columns of `documents`, and others with clashing names."""
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in texts]
    df = spark.createDataFrame(rows, DOCUMENTS)
    if extra:
        df = df.selectExpr("*", *[f"doc_id as `{name}`" for name in EXTRA])
    return df


def none(spark):
    return spark.createDataFrame([], DOCUMENTS)


def copies(rng, many=60):
    """Texts of which many are edited copies of each other, with a passage that most of them share."""
    passage = prose(rng, 30)
    bases = [prose(rng, rng.randrange(6, 160)) for _ in range(8)]
    texts = []
    for k in range(many):
        words = rng.choice(bases).split()
        for _ in range(rng.randrange(4)):
            at = rng.randrange(len(words))
            words[at : at + rng.randrange(2)] = [f"edit{rng.randrange(30)}"]
        if rng.random() < 0.5:
            words += passage.split()
        texts.append((100 + k, " ".join(words).upper() if rng.random() < 0.1 else " ".join(words)))
    return texts


def seeded(number):
    return random.Random(number)
