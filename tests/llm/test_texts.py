"""License scans and quotation linking."""

from __future__ import annotations

import textwrap

import pytest
from pyspark.sql import functions as F

from syncloom.llm import licenses, quotes
from syncloom.llm.common import ascii_lower

ISC = dict(licenses.KNOWN)["ISC"]

TEXTS = [
    (1, "Released under the MIT License."),
    (2, "RELEASED under the mit licence!!"),
    (3, "Some prose.\nLicensed under CC BY-NC 4.0.\nMore prose.\nReleased under the MIT License."),
    (4, "Copyright 2020 Somebody\n(c) 2021 Somebody Else\n\n" + ISC.upper().replace(" ", "  ")),
    (5, "Released under the MIT License. And more."),
    (6, None),
    (7, " \n "),
    (1, "Released under the MIT License."),
    (None, "Licensed under the Apache License, version 2.0"),
    (8, "Released under the MIT License.\nReleased under the MIT License."),
]


def scanned(spark, unit):
    docs = spark.createDataFrame([(k, t, "x") for k, t in TEXTS], "doc_id long, text string, licenses string")
    found = licenses.scan(docs, licenses.known_texts(spark), unit=unit)
    assert found.columns == docs.columns
    rows = found.select("doc_id", "licenses.*").collect()
    return sorted(((r.doc_id, r.licenses, r.n_matches) for r in rows), key=repr)


def test_whole_texts(spark):
    assert scanned(spark, "document") == sorted(
        [(1, ["MIT"], 1), (2, ["MIT"], 1), (3, [], 0), (4, ["ISC"], 1), (5, [], 0), (6, [], 0), (7, [], 0),
         (1, ["MIT"], 1), (None, ["Apache-2.0"], 1), (8, [], 0)],
        key=repr,
    )


def test_lines(spark):
    found = {k: (names, n) for k, names, n in scanned(spark, "line")}
    assert found[3] == (["CC-BY-NC-4.0", "MIT"], 2)
    assert found[8] == (["MIT"], 2) and found[1] == (["MIT"], 1) and found[5] == ([], 0)


def test_spellings_and_copyright_lines(spark):
    rows = spark.createDataFrame(
        [("The  Sub-Licence,\nCopyright (C) 1999 A\nCopyright B\nis non-commercial.",)], "text string"
    )
    found = rows.select(licenses.canonical(F.col("text"))).first()[0]
    assert found == "the sublicense is noncommercial"


def wrapped(text, width):
    """The text filled anew, but for the lines that name the holder."""
    parts = text.split("\n\n")
    return "\n\n".join(p if p.startswith("Copyright") else textwrap.fill(p, width) for p in parts)


def test_published_texts_match_at_any_width(spark):
    rows, names = [], []
    for name, text in licenses.full_texts():
        filled = text.replace("<year>", "2021").replace("<copyright holders>", "Jo Doe").replace("<copyright holder>", "Jo Doe")
        for width in (40, 72, 100_000):
            rows.append((len(names), wrapped(filled, width).replace('"', "\u201c").replace("'", "\u2019")))
            names.append(name)
    long = len(names)
    rows += [(long, "word " * 100_000), (long + 1, rows[0][1] + " and more terms"), (long + 2, "prose\n\n" + rows[0][1].partition("\n\n")[2])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = licenses.scan(docs, licenses.known_texts(spark)).select("doc_id", "licenses.*").collect()
    assert {r.doc_id: r.licenses for r in found} == {
        **{i: [n] for i, n in enumerate(names)}, long: [], long + 1: [], long + 2: []
    }


def test_paragraphs(spark):
    notice = "Released under the MIT License."
    docs = spark.createDataFrame([(1, f"prose\n \n{notice}\n\nmore"), (2, f"prose\n{notice}"), (3, notice)], "doc_id long, text string")
    count = lambda unit: {r.doc_id: r.licenses.n_matches for r in licenses.scan(docs, licenses.known_texts(spark), unit=unit).collect()}
    assert count("paragraph") == {1: 1, 2: 0, 3: 1}
    assert count(licenses.UNITS) == {1: 1, 2: 1, 3: 1}


def test_neighbouring_spellings(spark):
    rows = spark.createDataFrame([("licence licence sub-licence licences per cent per cent v2 V3",)], "text string")
    found = rows.select(licenses.canonical(F.col("text"))).first()[0]
    assert found == "license license sublicense licenses percent percent version 2 version 3"


def test_licenses_of_nothing(spark, docs, nulls):
    known = licenses.known_texts(spark)
    assert licenses.scan(docs.where("false"), known).isEmpty()
    none = licenses.scan(nulls, known.where("false")).select("licenses.*")
    assert {r.n_matches for r in none.collect()} == {0} and none.count() == nulls.count()
    with pytest.raises(ValueError):
        licenses.scan(docs, known, unit="page")


def test_ascii_lower(spark, docs, texts):
    rows = docs.select("doc_id", ascii_lower(F.col("text")).alias("low")).collect()
    plain = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
    assert all(r.low == (texts[r.doc_id] and texts[r.doc_id].translate(plain)) for r in rows)


MESSAGES = [
    (1, 0, "Shall we meet?\nAt noon, or later."),
    (1, 1, "Something else."),
    (1, 2, "> Shall we MEET\nYes."),
    (1, 3, "> > shall we meet?\n> Yes!\nFine then."),
    (1, 4, "> Something else.\n> At noon, or later\n> shall we meet\nBoth."),
    (1, 5, ">not from here\nhm"),
    (2, 0, "Yes."),
    (2, 1, None),
    (2, 2, ">  yes\n\t> yes\n"),
    (2, None, "> Yes."),
    (None, 0, "lost"),
    (None, 1, "> lost\nfound"),
    (3, 0, "same"),
    (3, 0, "same"),
    (3, 1, "> same\nok"),
    (3, 1, "> same\nok"),
]


@pytest.fixture(scope="module")
def linked(spark):
    table = spark.createDataFrame(
        [(c, t, x, 9, 9) for c, t, x in MESSAGES], "conv_id long, turn long, text string, reply int, _side int"
    )
    found = quotes.link_quotes(table)
    assert sorted(found.columns) == sorted(table.columns)
    rows = found.select("conv_id", "turn", "reply.*").collect()
    assert len(rows) == len(MESSAGES)
    return {(r.conv_id, r.turn): r for r in rows}


def test_replies(linked):
    replies = {k: r.reply_to for k, r in linked.items() if r.reply_to is not None}
    assert replies == {(1, 2): 0, (1, 3): 2, (1, 4): 0, (2, 2): 0, (None, 1): 0, (3, 1): 0}


def test_threads(linked):
    threads = {k: r.thread for k, r in linked.items() if r.thread != k[1]}
    assert threads == {(1, 2): 0, (1, 3): 0, (1, 4): 0, (2, 2): 0, (None, 1): 0, (3, 1): 0}


def test_bodies_and_depths(linked):
    assert linked[1, 3].body == "Fine then." and linked[1, 3].deepest == 2 and linked[1, 3].n_quoted == 2
    assert linked[2, 1].body == "" and linked[2, 1].deepest == 0
    assert linked[2, 2].body == "" and linked[2, 2].n_quoted == 2
    assert linked[1, 0].body == "Shall we meet?\nAt noon, or later."


def test_a_long_chain_of_replies(spark):
    rows = [(1, 0, "line 0")] + [(1, t, f"> line {t - 1}\nline {t}") for t in range(1, 40)]
    found = quotes.link_quotes(spark.createDataFrame(rows, "conv_id long, turn long, text string"))
    assert {r.thread for r in found.select("reply.*").collect()} == {0}


def test_wrapped_deep_and_hot_quotes(spark):
    rows = [
        (1, 0, "The river is high today. We should\nnot cross it before the\nevening comes."),
        (1, 1, "> The river is high\n> today. We should not\n> cross it before the evening comes.\nAgreed."),
        (1, 2, "> > The river is high today.\n> > We should not cross it\n> > before the evening comes."),
        (1, 3, ">>> We should not cross it before the evening comes.\nStill?"),
        (2, 0, "nothing to quote"),
        (2, 1, "> > nobody said that\nhm"),
    ]
    rows += [(3, t, "> Me too\nMe too") for t in range(3000)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, text string").repartition(5)
    for hot_rows, span in ((1 << 20, 1 << 20), (50, 100)):
        found = quotes.link_quotes(table, hot_rows=hot_rows, span=span).select("conv_id", "turn", "reply.*").collect()
        links = {(r.conv_id, r.turn): r.reply_to for r in found}
        assert [links[1, t] for t in range(4)] == [None, 0, 1, 2]
        assert links[2, 1] is None
        assert all(links[3, t] == (t - 1 if t else None) for t in range(3000))
        depth = {(r.conv_id, r.turn): (r.thread, r.depth) for r in found}
        assert depth[1, 3] == (0, 3) and depth[3, 2999] == (0, 2999) and depth[2, 1] == (1, 0)


def test_a_very_long_message_is_read_to_its_end(spark):
    tail = "and here is the last word of it"
    rows = [(1, 0, "filler words here\n" * 20_000 + tail), (1, 1, f"> {tail}\nyes"), (1, 2, "> filler words\n> here\nno")]
    found = quotes.link_quotes(spark.createDataFrame(rows, "conv_id long, turn long, text string"))
    assert {r.turn: r.reply.reply_to for r in found.collect()} == {0: None, 1: 0, 2: 0}


def test_chats_without_quotes(spark):
    rows = [(1, 0, "u", "one"), (1, 1, "a", "> one\ntwo"), (1, 2, "u", "three"), (1, 3, "a", "> two\nfour"), (1, None, "u", "x")]
    found = quotes.link_quotes(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    lines = quotes.chat(found).orderBy("conversation", "thread", "depth", "turn").collect()
    assert [(r.thread, r.turn, r.reply_to, r.role, r.content) for r in lines] == [
        (0, 0, None, "u", "one"), (0, 1, 0, "a", "two"), (0, 3, 1, "a", "four"), (2, 2, None, "u", "three")
    ]


def test_quotes_of_nothing(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, text string")
    assert quotes.link_quotes(none).isEmpty()
