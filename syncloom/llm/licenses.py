"""License scans: canonical texts, looked up by digest in a table of known texts."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from syncloom.llm.common import Scratch, ascii_lower, fresh, named, packed, row_key, small

#: Lines that say who holds a copyright since when say nothing about the terms: the word or sign at
#: their start, and then a sign, a year, a holder's place in brackets, or "by"; lines of a name alone
#: after the word; and the reservation of rights. For texts in lower case.
COPYRIGHT_LINE = (
    r"(?m)^[ \t#*/;-]*(?:(?:copyright|\(c\)|©)[ \t:,]*)+(?:(?:19|20)[0-9]{2}|[<\[{]|by[ \t])[^\n]*$|"
    r"^[ \t#*/;-]*copyright[ \t:,]*(?:\(c\)|©)[^\n]*$|"
    r"^[ \t#*/;-]*(?:©|\(c\)[ \t])[^\n]*$|"
    r"^[ \t#*/;-]*copyright[ \t]+[^ \t\n]+(?:[ \t]+[^ \t\n]+)?[ \t]*$|"
    r"^[ \t#*/;-]*all rights reserved[.]?[ \t]*$"
)
#: A text without any of these has no such line.
COPYRIGHT_SIGNS = ("copyright", "(c)", "©", "all rights reserved")
#: ASCII marks, and the signs, typographic quotes, dashes and blanks of two further ranges.
PUNCTUATION = r"[\x00-\x2F\x3A-\x60\x7B-\x7F\x{A0}-\x{BF}\x{D7}\x{F7}\x{2000}-\x{206F}]+"

#: Spellings that count as equal: a pattern of words that have a blank on either side,
#: and what stands for them.
SPELLINGS = (
    (" licenc(e|es|ed|ing) ", " licens$1 "),
    (" organisation([a-z]*) ", " organization$1 "),
    (" merchantibility ", " merchantability "),
    (" (fav|hon)our([a-z]*) ", " $1or$2 "),
    (" while ", " whilst "),
    (" per  cent ", " percent "),
    (" non  commercial ", " noncommercial "),
    (" sub  (license[sd]?|licensing) ", " sub$1 "),
    (" v([23]) ", " version  $1 "),
)
#: A text without any of these needs no second look for spellings.
SPELLED = (
    "licenc", "organisation", "merchantibility", "favour", "honour", "while", "per cent",
    "non commercial", "sub licens", "v2", "v3",
)

#: License ids and short notices.
KNOWN = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Released under CC0 1.0."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or"
        " without fee is hereby granted, provided that the above copyright notice and this"
        " permission notice appear in all copies.\nTHE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR"
        " DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF"
        " MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL,"
        " DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS"
        " OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS"
        " ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
)
#: Licenses in full, a file each, as they are published; the file's name is the license's id.
FULL_TEXTS = Path(__file__).parent / "license_texts"
#: What a unit of a text is: the whole, paragraphs between blank lines, lines.
UNITS = ("document", "paragraph", "line")


def _let(value: Column, make) -> Column:
    """What is made of a value that several places of the expression read: it is computed once."""
    return F.get(F.transform(F.array(value), make), F.lit(0))


def canonical(text: Column) -> Column:
    """The text without case, punctuation, copyright lines and variant spellings."""
    low = ascii_lower(F.coalesce(text, F.lit("")))
    plain = _let(low, lambda x: F.when(_any_of(x, COPYRIGHT_SIGNS), F.regexp_replace(x, COPYRIGHT_LINE, "")).otherwise(x))
    words = _let(plain, lambda x: F.btrim(F.regexp_replace(x, PUNCTUATION, " ")))
    return _let(words, lambda x: F.when(_any_of(x, SPELLED), _spelled(x)).otherwise(x))


def _any_of(text: Column, parts: tuple[str, ...]) -> Column:
    found = F.lit(False)
    for part in parts:
        found = found | text.contains(part)
    return found


def _spelled(words: Column) -> Column:
    # With two blanks between words, neighbours do not share the one that a pattern takes.
    apart = F.concat(F.lit(" "), F.replace(words, F.lit(" "), F.lit("  ")), F.lit(" "))
    for variant, usual in SPELLINGS:
        apart = F.regexp_replace(apart, variant, usual)
    return F.btrim(F.regexp_replace(apart, " +", " "))


def digest(text: Column) -> Column:
    return F.sha2(canonical(text), 256)


def full_texts() -> tuple[tuple[str, str], ...]:
    """The published texts, and those that begin with a title also without it."""
    found = []
    for file in sorted(FULL_TEXTS.glob("*.txt")):
        text = file.read_text(encoding="utf-8")
        title, _, rest = text.partition("\n\n")
        found.append((file.stem, text))
        if len(title.split()) < 10:
            found.append((file.stem, rest))
    return tuple(found)


def known_texts(spark: SparkSession, known: tuple[tuple[str, str], ...] | None = None) -> DataFrame:
    """(license, digest), each once; the notices above and the full texts unless others are given."""
    texts = KNOWN + full_texts() if known is None else known
    rows = spark.createDataFrame(list(texts), "license string, text string")
    return rows.select("license", digest(F.col("text")).alias("digest")).distinct()


def units_of(text: Column, unit: str) -> Column:
    """The pieces of a text whose whole is looked up."""
    body = F.coalesce(text, F.lit(""))
    if unit == "document":
        return F.array(body)
    return F.split(body, r"\n(?:[ \t\r]*\n)+" if unit == "paragraph" else "\n")


def scan(
    docs: DataFrame,
    known: DataFrame,
    unit: str | tuple[str, ...] = "document",
    key: str = "doc_id",
    text: str = "text",
    out: str = "licenses",
) -> DataFrame:
    """The documents with a struct: licenses (sorted, each once) and n_matches.

    The entire text of a unit, a document, each of its paragraphs or each of its lines, has to be a
    known text; of several units all are looked up, and a piece that is whole in more than one way,
    such as a document of one line, counts once. Texts that are empty in canonical form match
    nothing. `known` has (license, digest); a text that stands for two licenses counts as a match
    of both.

    Null texts match nothing, texts of any length are read whole; null keys and rows that repeat are
    scanned like others, by their own text. Empty tables on either side are fine. A column called
    `out` is replaced.
    """
    wanted = (unit,) if isinstance(unit, str) else tuple(unit)
    if not wanted or set(wanted) - set(UNITS):
        raise ValueError(f"unknown unit {unit}")
    scratch = Scratch(docs.sparkSession, "licenses")
    # Units of the same text share a row, so that repeated documents count alike.
    keyed = docs.select(row_key(named(key), named(text)).alias("row"), named(text).cast("string").alias("text"))
    names = small(scratch.write(known.where("license is not null"), "known"), ["license", "digest"])
    hits = None
    for at, one in enumerate(u for u in UNITS if u in wanted):
        cut = keyed.select("row", units_of(F.col("text"), one).alias("pieces"))
        if at:  # what is of one piece was looked up as a larger unit
            cut = cut.where(F.size("pieces") > 1)
        pieces = cut.select("row", F.posexplode("pieces").alias("place", "piece"))
        hashed = pieces.select("row", "place", canonical(F.col("piece")).alias("canon"))
        found = (
            hashed.where("canon <> ''")
            .select("row", "place", F.sha2("canon", 256).alias("digest"))
            .join(names, "digest")
            .select("row", F.lit(at).alias("unit"), "place", "license")
            .distinct()
        )
        hits = found if hits is None else hits.unionByName(found)
    if len(wanted) > 1:
        hits = _once(scratch.write(hits, "hits"))
    found = hits.groupBy("row").agg(
        F.sort_array(F.collect_set("license")).alias("licenses"), F.count(F.lit(1)).alias("n_matches")
    )
    own = [c for c in docs.columns if c.lower() != out.lower()]
    row, side = fresh(docs, "_row", "_side")
    found = small(packed(scratch.write(found, "found"), side), [side])
    hit = named(side)
    joined = docs.withColumn(row, row_key(named(key), named(text))).join(
        found, named(row) == hit["row"], "left"
    )
    return joined.select(
        *map(named, own),
        F.struct(
            F.coalesce(hit["licenses"], F.array().cast("array<string>")).alias("licenses"),
            F.coalesce(hit["n_matches"], F.lit(0).cast("long")).alias("n_matches"),
        ).alias(out),
    )


def _once(hits: DataFrame) -> DataFrame:
    """Per row and license, the matches of the unit that has the most: what several units find of a
    license is the same places, seen in larger pieces and in smaller ones."""
    counted = hits.groupBy("row", "license", "unit").agg(F.count(F.lit(1)).alias("n"))
    most = counted.groupBy("row", "license").agg(F.max("n").alias("n"))
    return most.select("row", "license", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("place"))
