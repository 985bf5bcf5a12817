from __future__ import annotations

import random

import pytest
from pyspark.sql import Row

WORDS = "the of and to in a is that red green blue stone river cloud paper lamp seven nine".split()


def prose(seed: int, n: int, lines: int = 1) -> str:
    rng = random.Random(seed)
    words = [rng.choice(WORDS) + str(rng.randrange(200) or "") for _ in range(n)]
    return "\n".join(" ".join(words[i::lines]) for i in range(lines))


def altered(text: str, seed: int, share: float) -> str:
    """The text with that share of its words replaced."""
    rng = random.Random(seed)
    return " ".join(f"x{rng.randrange(10**6)}" if rng.random() < share else w for w in text.split(" "))


ODD = {
    900: None,
    901: "",
    902: " \n\t ",
    903: "one",
    904: "A b  C\r\nd\x0be\x0cf",
    905: "one",
    906: "Ünï çode  naïve   tëxt nbsp   em\nline",
    907: "### *** $$$ ||| <> " * 20,
    908: "word " * 6000,
    909: "\x00nul \x1c sep\x85next ",
    910: " lead and trail ",
}


@pytest.fixture(scope="session")
def texts() -> dict[int, str | None]:
    """Prose, exact and near copies, shared passages and lines, and odd texts."""
    found: dict[int, str | None] = {i: prose(i, 40 + 7 * (i % 23), 1 + i % 4) for i in range(60)}
    base, passage = prose(1000, 150), prose(1001, 60)
    for i in range(40):
        found[100 + i] = altered(base, i, 0.002 * (i % 12))
    for i in range(15):
        found[200 + i] = base.upper() if i % 2 else base
    for i in range(25):
        found[300 + i] = prose(2000 + i, 30 + i) + " " + passage + " " + prose(3000 + i, 40)
    for i in range(14):
        found[400 + i] = f"start {i}\n  Shared LINE here \nend {i}\nshared line HERE\n{prose(i, 20)}"
    return found | ODD


@pytest.fixture(scope="session")
def docs(spark, texts):
    """The texts as a table with columns whose names the operators use themselves."""
    rows = [
        Row(
            doc_id=k,
            text=t,
            source=None if k % 7 == 0 else "hot" if k % 3 else f"s{k % 5}",
            shard="x",
            quality=k,
            _side=k,
            _key="k",
            size=1,
        )
        for k, t in texts.items()
    ]
    schema = "doc_id long, text string, source string, shard string, quality long, _side long, _key string, size int"
    return spark.createDataFrame(rows, schema).repartition(5)


@pytest.fixture(scope="session")
def empty(docs):
    return docs.where("doc_id < 0")


@pytest.fixture(scope="session")
def nulls(spark):
    """Rows that repeat, share an id, or have nothing but nulls."""
    rows = [(1, "same text here", "a")] * 3 + [(1, "another text", "a"), (None, None, None)]
    rows += [(None, "same text here", None), (None, "same text here", None), (2, "", "b")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")
