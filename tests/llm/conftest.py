import pytest
from pyspark.sql import types as T

LONG = " ".join(f"word{k % 977}x{k % 89}" for k in range(60_000))
PASSAGE = " ".join(f"shared{k}" for k in range(60))
BASE = [f"w{k}" for k in range(300)]


@pytest.fixture(scope="session")
def awkward():
    """Nulls, empty and long texts, ties, repeated rows, and shared passages."""
    near = [*BASE]
    near[100] = "changed"
    return [
        (1, None, "a"), (2, "", "a"), (3, " \t\n ", "b"), (4, "one", "b"), (5, "One", None), (6, "a b c d", "c"), (7, "a b c d", "c"),
        (8, " ".join(BASE), "a"), (9, " ".join(BASE), "a"), (10, " ".join(near), "d"), (11, " \n".join(near), "d"), (12, LONG, "e"),
        (13, "before " + PASSAGE + " after", "a"), (14, PASSAGE + " " + PASSAGE, "b"), (15, "über " + PASSAGE.upper() + " naïve 日本", "b"),
        (16, PASSAGE, "a"), (16, PASSAGE, "a"), (16, "same id, other text", "z"), (None, PASSAGE, "a"), (None, "no id at all", None), (None, "no id at all", None),
        (17, "ab" * 5_000, "f"), (18, "ab" * 3_000 + " end", "f"), (19, "x" * 70_000, "f"), (-3, "negative id " + PASSAGE[:200], "g"), (20, "line 1\n\nline 2\r\n\tx", "g"),
    ]


EXTRA = ("text_hash", "block", "node", "n_words", "score", "key", "slice", "size", "gone", "line", "bucket", "n", "component", "kept", "digest", "doc", "id",
         "payload", "shard", "target", "label", "place", "path", "statistics", "class", "turn", "question", "part", "failing", "good", "toxic", "survivors", "step")


@pytest.fixture(scope="session")
def frame(spark):
    """Documents as a DataFrame; with extra columns whose names clash with those inside the operators."""
    def make(rows, extra=True):
        names = EXTRA if extra else ()
        schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("source", T.StringType()),
                               *(T.StructField(n, T.StringType()) for n in names)])
        return spark.createDataFrame([(*r, *(None if k % 2 else "x" for k in range(len(names)))) for r in rows], schema)
    return make


@pytest.fixture
def sure():
    """Rows as sorted tuples that compare nulls and repeated rows."""
    def collect(rows, digits=None):
        out = [tuple(round(v, digits) if isinstance(v, float) and digits is not None else v for v in r) for r in rows]
        return sorted(out, key=lambda r: [(v is not None, v) for v in r])
    return collect
