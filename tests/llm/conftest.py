import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, _row string, kept string, node long, n long"


def prose(seed, n, vocabulary=400):
    r = random.Random(seed)
    return [f"w{r.randrange(vocabulary)}x{r.randrange(9)}" for _ in range(n)]


def hard_texts():
    """Nulls, empty and blank texts, copies, near copies, moved blocks, shared passages, one very long text."""
    base, other = prose(1, 300), prose(2, 300)
    near = base[:]
    near[40], near[200] = "changed", "here"
    passage = prose(3, 60)
    long = prose(4, 30_000, 5000)
    return [
        None, "", " \n\t ", "one", "two words", " ".join(base), " ".join(base), "  ".join(base), " ".join(near),
        " ".join(base[150:] + base[:150]), " ".join(other[:100] + passage + other[100:]),
        " ".join(prose(5, 80) + passage), " ".join(passage), " ".join(passage[:50]), " ".join(passage[:49]),
        " ".join(long), " ".join(long[:20_000] + ["cut"] + long[20_000:]), "For " * 400, "For " * 380,
        "a line that stands here twice\na line that stands here twice\n\nand another line",
        "a line that stands here twice!\nsomething else entirely, in other words", "ä ö\x0bü\x0cß\r\nä ö",
        "<|im_end|> ▁ <0x41> \U0001f600 \u0000 end", "x" * 3000, "y " * 3,
    ]


@pytest.fixture(scope="session")
def hard(spark):
    """Documents with every awkward case, extra columns with clashing names, a hot and a null source."""
    rows = [(i, t, "en", None if i == 3 else "hot" if i % 3 else f"s{i % 5}", len(t or ""), "r", "k", i, 1)
            for i, t in enumerate(hard_texts())]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="session")
def odd(spark):
    """Repeated rows, repeated and null ids."""
    a, b = " ".join(prose(1, 120)), " ".join(prose(9, 120))
    rows = [(1, a), (1, a), (1, b), (2, a), (None, a), (None, None), (3, b), (3, b), (4, None)]
    return spark.createDataFrame([(i, t, "en", "s", 1, "r", "k", 1, 1) for i, t in rows], DOCS)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)
