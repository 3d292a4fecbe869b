import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
VOCABULARY = "the and of stone river light of in to walks under seven quiet birds near old harbour".split()


def prose(rng, n):
    return " ".join(rng.choice(VOCABULARY) + rng.choice(["", "", "", ",", "."]) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty and long texts, ties, repeated rows, copies and near copies."""
    rng = random.Random(7)
    base = [prose(rng, n) for n in (3, 9, 10, 25, 60, 61, 200, 3000)]
    near = base[6].replace("stone", "Stone!", 2)
    texts = [*base, base[4], base[4], near, "", "   \n\t ", None, "one", "ÀÉ ßtraße naïve 漢字 🙂 x", "a " * 300]
    texts += [base[3] + "\n" + base[5], base[5] + " tail words here", "\x1c odd\x1dseparators \x85 here"]
    rows = [(k, t, "en", f"src{k % 3}", None if t is None else len(t)) for k, t in enumerate(texts)]
    rows += [rows[4], rows[4], (5, "another text under an id that is taken", None, None, None)]
    rows += [(None, base[7], None, None, None), (None, None, None, None, None), (None, base[2], "en", "src1", 1)]
    return rows


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def widen():
    """Extra columns whose names operators use themselves."""
    from pyspark.sql import functions as F

    names = "row key copy fp label part rank words at salt host prior found length component_id".split()

    def run(df):
        return df.withColumns({n: F.lit(f"extra {n}") for n in names if n not in df.columns})

    return run


def rows_of(df, *columns):
    """Rows as sorted tuples, nulls last."""
    rows = [tuple(r) for r in df.select(*(columns or df.columns)).collect()]
    return sorted(rows, key=lambda r: [(x is None, x) for x in r])


@pytest.fixture(scope="session")
def listed():
    return rows_of
