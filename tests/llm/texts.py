"""Small tables for the tests of the text operators."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SYLLABLES = "an the er on re ing ti es or st en at ed nd ha".split()


def sentence(rng, words):
    return " ".join("".join(rng.choices(SYLLABLES, k=rng.randint(1, 3))) for _ in range(words))


def odd_texts():
    """Null, empty, blank, very long, and texts that tie or repeat."""
    rng = random.Random(5)
    long = "\n".join(sentence(rng, 40) for _ in range(120))
    passage = sentence(rng, 60)
    return [
        None, "", " \t\n ", "one", "one two three", "One TWO three", passage, passage,
        f"{sentence(rng, 30)} {passage} {sentence(rng, 25)}",
        f"{sentence(rng, 12)} {passage}", long, long + " tail", long.replace("the", "der", 3),
        "x\ny\nx\ny\nx\ny", "日本 ☃ ä b", "a " * 300, "###$$$ " * 80,
    ]


def documents(spark, texts, extra=False):
    rows = [(i, t, "ab"[i % 2] if i % 5 else None, f"s{i % 3}" if i % 7 else None,
             len(t) if t is not None else None) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, SCHEMA)
    if extra:  # names that results and working columns use
        df = df.selectExpr("*", "'x' AS key", "1 AS size", "2 AS rank", "'y' AS ids", "0.5D AS score",
                           "3 AS n_words", "4 AS n_removed", "'z' AS target", "5 AS component",
                           "6 AS g", "7 AS at", "8 AS n_lines", "'l' AS lang_pred", "9 AS gone",
                           "1 AS n", "2 AS epoch", "3 AS cell", "4 AS posterior", "'v' AS votes")
    return df


def near_copies(seed=1, groups=6, size=9, words=60):
    """Groups of texts with edits of one another, so that links form chains and stars."""
    rng = random.Random(seed)
    out = []
    for _ in range(groups):
        base = sentence(rng, words).split()
        out.append(" ".join(base))
        for _ in range(size - 1):
            copy = list(base)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = sentence(rng, 1) + str(rng.randrange(99))
            if rng.random() < 0.3:
                base = copy
            out.append(" ".join(copy))
    return out
