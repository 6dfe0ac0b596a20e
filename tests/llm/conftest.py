import random

import pytest
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

DOC = [("doc_id", LongType()), ("text", StringType()), ("lang", StringType()), ("source", StringType()), ("n_chars", LongType())]
# names that operators use inside
CLASHING = "row_id id hash size tag target token gid cid n comp _row bucket rep held_out score ids at block label".split()
SCHEMA = StructType([StructField(n, t) for n, t in DOC] + [StructField(n, IntegerType()) for n in CLASHING])


def invented(rng, n, vocabulary=400):
    words = ["".join(rng.choice("abcdeéfgh") for _ in range(rng.randint(1, 7))) for _ in range(vocabulary)]
    return [w + rng.choice(["", "", "", ",", "."]) for w in rng.choices(words, k=n)]


def corpus(seed=7, n=60):
    """Invented texts: copies, near copies, shared passages, and the odd cases: null, empty, blank, very long, repeated rows."""
    rng = random.Random(seed)
    passage = " ".join(invented(rng, 60))
    texts = [" ".join(invented(rng, rng.randint(1, 120))) for _ in range(n)]
    for i in range(0, n, 6):
        words = invented(rng, 90)
        texts.append(" ".join(words))
        texts.append(" ".join(words))
        words[rng.randrange(90)] = "changed"
        texts.append(" ".join(words))
        texts.append(" ".join(invented(rng, 30)) + ". " + passage + "\n" + " ".join(invented(rng, 30)))
    texts += [None, "", " \t\n", "one", "one two", "One TWO", "x" * 50_000, " ".join(invented(rng, 20_000)), "\x1c   é", "same line\n" * 40]
    rows = [(i, t, "en", f"s{i % 4}" if i % 3 else "s0", len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[3], rows[3], rows[-1], (None, "null id", None, None, None), (None, None, None, None, None), (7, "other text under an id", "en", None, 1)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, *([1] * len(CLASHING))) for r in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("odd") / "documents.parquet")
    frame(spark, rows).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
