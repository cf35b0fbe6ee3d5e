import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, part int, block string, score double, row string, votes int"


def words(rng, n, stock=("the", "of", "and", "tion", "ere", "under", "license", "outh", "ban", "Émen")):
    return " ".join("".join(rng.choice(stock) for _ in range(rng.randint(1, 3))) for _ in range(n))


def texts():
    """Nulls, empty and long texts, exact and near copies, repeats, split characters."""
    rng = random.Random(3)
    passage = words(rng, 20)
    long = words(rng, 4000)
    near = words(rng, 150).split()
    out = [None, "", " \t\n", "One", "two words", "Tie. Tie. Tie.", "ab" * 400, "é" * 120, "x" * 49, "x" * 50, "x" * 51]
    out += [long, words(rng, 30) + passage + words(rng, 10), passage + "\n" + words(rng, 40), words(rng, 5) + passage, passage]
    out += ["All rights reserved. CC-BY 4.0 all Rights reserved", "GNU General Public License", "licensed under the apache license version 2.0"]
    for i in range(6):
        copy = list(near)
        copy[20 * i + 3] = f"edit{i}"
        out.append(" ".join(copy))
    out += [out[-1], out[-1], long[:9000] + "é" + long[9000:], "🙂" * 60 + "a", "a" + "🙂" * 60]
    out += [words(rng, rng.randint(1, 80)) for _ in range(30)]
    return out


@pytest.fixture(scope="module")
def rows():
    order = list(range(len(texts())))
    random.Random(5).shuffle(order)
    return [(7 * i - 20, t, "en", f"src{i % 3}", len(t or "")) for i, t in zip(order, texts())]


@pytest.fixture(scope="module")
def docs(spark, rows):
    """With columns whose names the operators use themselves."""
    return spark.createDataFrame([(*r, 1, "b", 0.5, "r", 2) for r in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    """Rows without an id, with all values null, and repeated rows."""
    blank = (None,) * 8
    return spark.createDataFrame(
        [(None, None, *blank), (None, "some text of ours", *blank), (4, "same row here", *blank), (4, "same row here", *blank), (4, None, *blank)],
        SCHEMA,
    )
