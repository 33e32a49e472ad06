import random

import pytest
from pyspark.sql import types as T

WORDS = [a + b for a in ("ba", "ke", "lo", "mi", "nu", "è") for b in ("", "r", "st", "ng", "lé", "o", "T")]
#: Extra columns, most of them named as columns of the operators.
EXTRA = ["id", "n", "n_words", "selected", "items", "ids", "spans", "kept", "start", "component_id", "contaminated", "digest", "bands", "row"]
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       *[T.StructField(c, T.StringType()) for c in EXTRA]])


def prose(rng, n, line=12):
    words = [rng.choice(WORDS) for _ in range(n)]
    return "".join(w + ("\n" if i % line == line - 1 else " ") for i, w in enumerate(words)).strip()


def plain_rows(seed=1):
    """Documents with copies, near copies, shared passages, blank, null, short and very long texts."""
    rng = random.Random(seed)
    base = prose(rng, 150)
    passage = prose(rng, 70)
    texts = [None, "", "  \n\t ", "one", "one two three", "ONE two  three", base, base, base.replace(" ", "  "), base + " ", prose(rng, 6000)]
    for _ in range(14):
        w = base.split(" ")
        for _ in range(rng.randint(1, 3)):
            w[rng.randrange(len(w))] = rng.choice(WORDS) + "x"
        texts.append(" ".join(w))
    for _ in range(8):
        texts.append(prose(rng, rng.randint(5, 60)) + " " + passage + " " + prose(rng, rng.randint(0, 60)))
    texts += [" ".join(["con"] * 90), " ".join(["con"] * 60), "ab" * 300, "mail é.x@y.example.com and 4111 1111 1111 1111 or +1 (555) 123-4567 at 10.0.0.255.",
              passage.upper(), "漢字 😀 ▁ \x00 <s> <0x41>  x", prose(rng, 30) + "\n\n" + prose(rng, 30)]
    texts += [prose(rng, rng.randint(1, 120)) for _ in range(15)]
    rng.shuffle(texts)
    return [(7 * i % 1009, t) for i, t in enumerate(texts)]


def odd_rows():
    """The same with a null doc_id, repeated rows, and one doc_id for two texts."""
    rows = plain_rows(2)
    return [*rows, rows[5], rows[5], (rows[6][0], rows[7][1]), (None, rows[8][1]), (None, None), (None, None), (3, "")]


@pytest.fixture(scope="session", params=["plain", "odd", "empty"])
def rows(request):
    return {"plain": plain_rows, "odd": odd_rows, "empty": list}[request.param]()


def frame(spark, rows):
    return spark.createDataFrame([(d, t, *([str(i % 3)] if i % 4 else [None]) * len(EXTRA)) for i, (d, t) in enumerate(rows)], SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def docs(spark, rows):
    return frame(spark, rows).cache()


def bag(rows):
    return sorted(map(repr, rows))
