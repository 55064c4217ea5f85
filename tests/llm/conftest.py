import random

import pytest

WORDS = "the of and in to is a on for with Über ñandú x1 y2 foo, bar. Baz <b> $5 50% # it's".split()


def _sentence(rng, n):
    return " ".join(rng.choice(WORDS) if rng.random() < 0.5 else f"w{rng.randrange(4000)}" for _ in range(n))


def awkward_rows():
    """``(doc_id, text, source)`` with nulls, blanks, copies, near copies, shared
    passages and lines, very long text, repeated rows and repeated ids."""
    rng = random.Random(7)
    passage = _sentence(rng, 45)
    line = "   Shared LINE that is long enough to count as boilerplate, É too \t"
    rows = [
        (1, None, "s"),
        (2, "", "s"),
        (3, " \t\r\n\x0b\x0c \n", None),
        (4, "one", "s"),
        (5, "One", "t"),
        (6, "one two three four", "t"),
        (7, "word with odd　blanks \x00 nul\x1f", "t"),
        (8, "a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a", "s"),
        (None, "a document without id " + _sentence(rng, 30), "s"),
        (None, None, None),
    ]
    for i in range(10, 40):
        body = [_sentence(rng, rng.randrange(1, 25)) for _ in range(rng.randrange(1, 8))]
        if i % 3 == 0:
            body.insert(rng.randrange(len(body) + 1), passage)
        if i % 2 == 0:
            body.insert(rng.randrange(len(body) + 1), line if i % 4 else line.strip().lower())
        if i % 5 == 0:
            body += [body[0], "", body[0]]
        rows.append((i, "\n".join(body), "hot" if i % 3 else f"s{i}"))
    rows += [(100 + i, rows[15][1], "hot") for i in range(12)]
    base = _sentence(rng, 400).split(" ")
    for i in range(12):
        near = list(base)
        for _ in range(i):
            near[rng.randrange(len(near))] = f"n{rng.randrange(1000)}"
        rows.append((200 + i, " ".join(near), "hot"))
    rows.append((300, "\n".join(_sentence(rng, 400) for _ in range(60)) + "\n" + passage, "long"))
    rows += [(4, "one", "s"), (12, "another text with a used id " + passage, "s"), rows[20], rows[20]]
    return rows


@pytest.fixture(scope="session")
def rows():
    return awkward_rows()


@pytest.fixture(scope="session")
def docs(spark, rows):
    """The rows as a table in several partitions, with columns whose names clash."""
    clashing = (
        "key string, id string, ref int, kind string, n int, n_words int, hits string, items int, a string, block int, "
        "text_hash string, mark int, score string, host string, h int, lines string, position string, word string"
    )
    names = [c.split(" ") for c in clashing.split(", ")]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    for name, kind in names:
        table = table.selectExpr("*", f"cast('7' as {kind}) AS {name}")
    return table


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, source string")


def result(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
