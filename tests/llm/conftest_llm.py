import random

import pytest

WORDS = "the of and to in that it was for on are with as his they at be this from have or by one had not but".split()


def prose(seed, n):
    random_ = random.Random(seed)
    return " ".join(
        random_.choice(WORDS) + random_.choice(["", "", "", "ing", "ed", "er", ","]) for _ in range(n)
    )


def rows():
    """Documents with every awkward case: nulls, blanks, copies, near copies, repeats and a very long one."""
    first = "\n".join(prose(i, 14) for i in range(6))
    second = "\n".join(prose(100 + i, 12) for i in range(5))
    texts = [
        (1, first),
        (2, first),
        (3, first.replace("and", "and", 1) + "\n" + prose(7, 3)),
        (4, second),
        (5, prose(8, 15) + "\n" + "\n".join(second.split("\n")[1:4]) + "\n" + prose(9, 15)),
        (6, None),
        (7, ""),
        (8, " \t\n \r\n"),
        (9, "!!! ??? 123"),
        (10, "Ça va très bien, merci beaucoup à tous.\r\nÀ bientôt"),
        (11, "x"),
        (12, "A b C"),
        (13, "\n".join(prose(1000 + i, 20) for i in range(1500))),
        (14, "same line of words that is long enough to count twice\n" * 40),
        (15, "same line of words that is long enough to count twice\n" * 3 + prose(11, 30)),
        (16, "SHOUT!! LOUD!! NOISE!! *** $$$ ### |\n" * 6),
        (17, prose(17, 200)),
        (17, prose(17, 200)),
        (18, prose(18, 40)),
        (18, prose(19, 40)),
        (None, prose(20, 30)),
        (None, second),
        (None, None),
        (20, "漢字 と かな 😀 ▁mark  two  blanks \x00 end"),
    ]
    langs = ["en", "fr", "en", None]
    return [(i, t, langs[n % 4], f"s{n % 3}", None if t is None else len(t)) for n, (i, t) in enumerate(texts)]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use for columns of their own.
CLASHES = ["score", "n_tokens", "key", "fp", "label", "chunk", "lang_pred", "n_lines", "copy", "component_id", "item"]


@pytest.fixture(scope="session")
def doc_rows():
    return rows()


@pytest.fixture(scope="session")
def docs(spark, doc_rows):
    return spark.createDataFrame(doc_rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def crowded(docs):
    """The same with further columns, named like those that operators add."""
    from pyspark.sql import functions as F

    return docs.select("*", *[F.lit("other").alias(n) for n in CLASHES])


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def as_sets(frame, columns):
    """Rows as a sorted list of texts, to compare without an order."""
    return sorted(repr(tuple(r)) for r in frame.select(*columns).collect())
