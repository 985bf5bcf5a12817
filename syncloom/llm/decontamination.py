"""Benchmark decontamination by a positional inverted index over the training text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from syncloom.llm.common import (
    Scratch,
    ascii_lower,
    fresh,
    named,
    packed,
    row_key,
    small,
)

#: Words are runs of a-z, 0-9 and all characters beyond ASCII, after A-Z became lower case.
BREAK_RUN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BREAKS = "".join(map(chr, [*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))
WINDOW = 13
#: So many of a window's rarest words are looked up.
DEPTH = 3


def terms(text: Column) -> Column:
    """The words of a text in order; none for null."""
    inner = F.btrim(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(BREAKS))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(
        F.split(inner, BREAK_RUN)
    )


def item_words(items: DataFrame, item: str = "item_id", text: str = "text") -> DataFrame:
    """(item_key, item_id, words): one row per id and text; items without id or words are left out."""
    found = items.select(
        row_key(named(item), named(text)).alias("item_key"),
        named(item).cast("string").alias("item_id"),
        terms(named(text)).alias("words"),
    )
    return found.where(F.col("item_id").isNotNull() & (F.size("words") > 0)).dropDuplicates(
        ["item_key"]
    )


def item_windows(items: DataFrame, width: int = WINDOW) -> DataFrame:
    """(item_key, first, last) of the windows; a shorter item is one window."""
    final = F.greatest(F.size("words") - width, F.lit(0))
    return items.select(
        "item_key", F.size("words").alias("_n"), F.explode(F.sequence(F.lit(0), final)).alias("first")
    ).select("item_key", "first", F.least(F.col("first") + width, F.col("_n")).alias("end"))


def term_counts(docs: DataFrame, vocabulary: DataFrame, text: str = "text") -> DataFrame:
    """(term, n): how often the words of the vocabulary stand in the training text, 0 included."""
    every = docs.select(F.explode(terms(named(text))).alias("term"))
    found = (
        every.join(small(vocabulary, ["term"]), "term", "left_semi")
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return vocabulary.join(found, "term", "left").select(
        "term", F.coalesce("n", F.lit(0)).alias("n")
    )


def rarest_terms(
    items: DataFrame, windows: DataFrame, counts: DataFrame, depth: int = DEPTH
) -> DataFrame:
    """(item_key, first, place, term, rank): the rarest words of each window that can occur.

    A window with a word that the training text never has is left out: it cannot occur.
    """
    placed = items.select("item_key", F.posexplode("words").alias("place", "term")).join(
        counts, "term"
    )
    inside = windows.join(placed, "item_key").where(
        (F.col("place") >= F.col("first")) & (F.col("place") < F.col("end"))
    )
    window = Window.partitionBy("item_key", "first")
    ranked = inside.withColumns(
        {
            "least": F.min("n").over(window),
            "rank": F.row_number().over(window.orderBy("n", "term", "place")),
        }
    )
    return ranked.where((F.col("least") > 0) & (F.col("rank") <= depth)).select(
        "item_key", "first", "place", "term", "rank"
    )


def postings(docs: DataFrame, wanted: DataFrame | None = None, text: str = "text") -> DataFrame:
    """(term, doc_key, position) for the words wanted, or for all words.

    `docs` has `doc_key`. Only words that a search asks for need postings: no other word can bring
    in a candidate.
    """
    every = docs.select("doc_key", F.posexplode(terms(named(text))).alias("position", "term"))
    if wanted is not None:
        every = every.join(small(wanted, ["term"]), "term", "left_semi")
    return every.select("term", "doc_key", "position")


def alignments(index: DataFrame, rarest: DataFrame, slop: int = 0) -> DataFrame:
    """(doc_key, item_key, shift, hits): where enough of an item's rarest words line up.

    Each posting, less the place of its word in the item, says where the item would begin. Lists
    that agree on that are intersected by counting the places that do: a window occurs only where
    its rarest words all agree. With `slop`, beginnings are counted by cells of that many words
    and by cells offset by half, which finds rarest words that stand near to their places.
    """
    anchors = rarest.select("item_key", "place", "term").distinct()
    needed = (
        rarest.groupBy("item_key", "first")
        .agg(F.count(F.lit(1)).alias("_k"))
        .groupBy("item_key")
        .agg(F.min("_k").alias("needed"))
    )
    met = index.join(small(anchors, ["item_key", "term"]), "term").withColumn(
        "shift", F.col("position") - F.col("place")
    )
    if slop:
        cells = F.array(
            F.floor(F.col("shift") / slop) * slop,
            F.floor((F.col("shift") + slop // 2) / slop) * slop - slop // 2,
        )
        cells = F.array_distinct(cells).cast("array<int>")
        met = met.withColumn("shift", F.explode(cells))
        counted = met.groupBy("doc_key", "item_key", "shift").agg(
            F.count_distinct("place").alias("hits")
        )
    else:
        # With one beginning, each place has one position, so rows need no distinct.
        counted = met.groupBy("doc_key", "item_key", "shift").agg(F.count(F.lit(1)).alias("hits"))
    return counted.join(small(needed, ["item_key"]), "item_key").where(
        F.col("hits") >= F.col("needed")
    )


def exact_windows(
    docs: DataFrame, items: DataFrame, found: DataFrame, scratch: Scratch, width: int = WINDOW
) -> DataFrame:
    """(doc_key, item_key, start, length): the windows that stand in a document word for word.

    `docs` has (doc_key, text). The pieces a document is compared on are cut out of it by its
    alignments, so that its words travel once.
    """
    sized = found.join(
        small(items.select("item_key", "words"), ["item_key", "words"]), "item_key"
    ).select("doc_key", "item_key", "shift", F.size("words").alias("length"))
    asked = sized.groupBy("doc_key").agg(
        F.collect_set(F.struct("item_key", "shift", "length")).alias("asked")
    )
    asked = small(scratch.write(asked, "asked"), ["asked"])
    pieces = (
        docs.join(asked, "doc_key")
        .select("doc_key", "asked", terms(F.col("text")).alias("_w"))
        .select(
            "doc_key",
            F.explode(
                F.expr(
                    "transform(asked, a -> struct(a.item_key as item_key, a.shift as shift,"
                    " slice(_w, greatest(a.shift, 0) + 1,"
                    " greatest(a.length + least(a.shift, 0), 0)) as piece))"
                )
            ).alias("a"),
        )
        .select("doc_key", "a.*")
    )
    # Words of the item before the document's first word have no partner.
    both = pieces.join(
        small(items.select("item_key", "words"), ["item_key", "words"]), "item_key"
    )
    equal = both.withColumn(
        "same",
        F.expr(
            "transform(words, (w, i) -> coalesce(i + shift >= 0 and"
            " w = get(piece, i + least(shift, 0)), false))"
        ),
    )
    long = F.least(F.size("same"), F.lit(width))
    starts = equal.withColumn("_long", long).withColumn(
        "starts",
        F.expr(
            "filter(sequence(0, size(same) - _long),"
            " s -> forall(slice(same, s + 1, _long), x -> x))"
        ),
    )
    return starts.select(
        "doc_key",
        "item_key",
        F.explode(F.expr("transform(starts, s -> s + shift)")).alias("start"),
        F.col("_long").alias("length"),
    )


def covered(spans: Column) -> Column:
    """How many places an array of sorted (start, length) covers."""
    return F.aggregate(
        spans,
        F.struct(F.lit(0).cast("long").alias("sum"), F.lit(0).cast("long").alias("end")),
        lambda acc, s: F.struct(
            (
                acc["sum"]
                + F.greatest(
                    s["start"] + s["length"] - F.greatest(s["start"].cast("long"), acc["end"]),
                    F.lit(0).cast("long"),
                )
            ).alias("sum"),
            F.greatest(acc["end"], (s["start"] + s["length"]).cast("long")).alias("end"),
        ),
        lambda acc: acc["sum"],
    )


def contamination(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    width: int = WINDOW,
    depth: int = DEPTH,
    percent: int = 5,
    out: str = "contamination",
    slop: int = 0,
) -> DataFrame:
    """The documents with a struct: n_words, n_hit, items, near, contaminated.

    A word is hit when it stands in an occurrence of a window of `width` words of an item; a
    shorter item is one window. A document is contaminated when words are hit, and at least
    `percent` percent of them. `items` are the ids of the items found, sorted as strings.

    With `slop`, `near` has the ids of items that stand nearby: the rarest words of a window line up
    to within so many words, whether they stand there word for word or with words put in, left out
    or moved. Such items contaminate nothing by themselves. Without `slop` there are none.

    The index has postings of the words that are looked up, the rarest ones of all windows, for the
    whole training text; other words could bring in no candidate. Null and empty texts have no words and are never contaminated. A null id is an id; rows that
    repeat id and text get equal results. Items without an id or without words are left out, and
    items that share an id count once. Empty tables on either side are fine. A column called `out`
    is replaced; others pass through.
    """
    scratch = Scratch(docs.sparkSession, "contamination")
    keyed = docs.select(
        row_key(named(key), named(text)).alias("doc_key"), named(text).alias("text")
    )
    tests = scratch.write(item_words(items, item, item_text), "items")
    windows = item_windows(tests, width)
    vocabulary = scratch.write(
        tests.select(F.explode("words").alias("term")).distinct(), "vocabulary"
    )
    counts = scratch.write(term_counts(keyed, vocabulary), "counts")
    rarest = scratch.write(rarest_terms(tests, windows, counts, depth), "rarest")
    wanted = scratch.write(rarest.select("term").distinct(), "wanted")
    # The index: sorted by term, so that a search reads the parts of its terms only.
    index = scratch.write(postings(keyed, wanted).sortWithinPartitions("term"), "index")
    found = scratch.write(alignments(index, rarest), "alignments")
    hits = scratch.write(exact_windows(keyed, tests, found, scratch, width).distinct(), "hits")
    spans = F.sort_array(F.collect_set(F.struct("start", "length")))
    ids = small(tests.select("item_key", "item_id"), ["item_key", "item_id"])
    per_doc = hits.join(ids, "item_key").groupBy("doc_key").agg(
        covered(spans).alias("n_hit"), F.sort_array(F.collect_set("item_id")).alias("items")
    )
    if slop:
        close = alignments(index, rarest, slop).join(ids, "item_key")
        close = close.groupBy("doc_key").agg(F.sort_array(F.collect_set("item_id")).alias("near"))
        per_doc = per_doc.join(close, "doc_key", "full")
    else:
        per_doc = per_doc.withColumn("near", F.lit(None).cast("array<string>"))
    per_doc = scratch.write(per_doc, "found")

    own = [c for c in docs.columns if c.lower() != out.lower()]
    join_key, size, side = fresh(docs, "_key", "_size", "_side")
    hit = named(side)
    per_doc = small(packed(per_doc, side), [side])
    # Sized before the join, so that a caller that drops the text need not move it.
    sized = docs.withColumns(
        {
            join_key: row_key(named(key), named(text)),
            size: F.size(terms(named(text))).cast("long"),
        }
    )
    joined = sized.join(per_doc, named(join_key) == hit["doc_key"], "left")
    n_hit = F.coalesce(hit["n_hit"], F.lit(0).cast("long"))
    return joined.select(
        *map(named, own),
        F.struct(
            named(size).alias("n_words"),
            n_hit.alias("n_hit"),
            F.coalesce(hit["items"], F.array().cast("array<string>")).alias("items"),
            F.coalesce(hit["near"], F.array().cast("array<string>")).alias("near"),
            ((n_hit > 0) & (100 * n_hit >= percent * named(size))).alias("contaminated"),
        ).alias(out),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The documents that are not contaminated, with the columns they came with."""
    (out,) = fresh(docs, "_contamination")
    found = contamination(docs, items, out=out, **options)
    return found.where(~named(out)["contaminated"]).drop(out)
