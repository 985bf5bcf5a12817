"""Chat formatting by quotation linking: messages reply to what they quote.

Lines that begin with `>` are quoted, as deep as they have marks. Lines of one depth that follow each
other are put together, however they are wrapped, and cut into sentences; each sentence, and each
line as it stands, is a passage with a digest, without case, marks and punctuation. A passage at
some depth stands one depth less deep in the message that is replied to; there it is looked up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from syncloom.llm.common import Scratch, ascii_lower, fresh, named, packed, small
from syncloom.operators.skew import HOT_ROWS, SLICE_ROWS, last_known

#: Quote marks at the start of a line, with blanks between them.
MARKS = r"^([ \t]*>)+[ \t]?"
PUNCTUATION = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Where a sentence ends.
SENTENCE = r"[.!?]+(?:\s+|$)"


def level(line: Column) -> Column:
    """How deep a line is quoted: 0 for the message's own words."""
    marks = F.regexp_extract(line, MARKS, 0)
    return F.length(marks) - F.length(F.translate(marks, ">", ""))


def _lines(text: Column) -> Column:
    """The lines; two characters that stand between runs below are taken for blanks."""
    return F.split(F.translate(F.coalesce(text, F.lit("")), "\x01\x02", "  "), "\n")


def passages(messages: DataFrame, conversation: str, turn: str, text: str) -> DataFrame:
    """(conversation, turn, level, hash) of the sentences and lines that have words.

    Lines of the same depth are one run until a blank line or another depth comes.
    """
    cut = messages.select(
        named(conversation).alias("conversation"), named(turn).alias("turn"), _lines(named(text)).alias("_l")
    ).where(F.col("turn").isNotNull())
    parted = cut.select(
        "conversation",
        "turn",
        F.transform("_l", level).alias("_d"),
        F.transform("_l", lambda x: F.btrim(F.regexp_replace(x, MARKS, ""))).alias("_t"),
    )
    goes_on = "i > 0 and _d[i] = _d[i - 1] and x <> '' and _t[i - 1] <> ''"
    joined = f"array_join(transform(_t, (x, i) -> concat(if({goes_on}, ' ', concat('\\u0001', _d[i], '\\u0002')), x)), '')"
    runs = parted.select("conversation", "turn", F.explode(F.split(F.expr(joined), "\x01")).alias("_r"))
    sentences = runs.where(F.col("_r") != "").select(
        "conversation",
        "turn",
        F.substring_index("_r", "\x02", 1).cast("int").alias("level"),
        F.explode(F.split(F.substring_index("_r", "\x02", -1), SENTENCE)).alias("_s"),
    )
    lines = parted.select("conversation", "turn", F.explode(F.arrays_zip("_d", "_t")).alias("_z")).select(
        "conversation", "turn", F.col("_z._d").cast("int").alias("level"), F.col("_z._t").alias("_s")
    )
    plain = F.btrim(F.regexp_replace(ascii_lower(F.col("_s")), PUNCTUATION, " "))
    return (
        sentences.unionByName(lines).select("conversation", "turn", "level", plain.alias("_n"))
        .where(F.col("_n") != "")
        .select("conversation", "turn", "level", F.unhex(F.md5("_n")).alias("hash"))
    )


def without_quotes(text: Column) -> Column:
    """The message's own lines."""
    lines = F.split(F.coalesce(text, F.lit("")), "\n")
    own = F.filter(lines, lambda line: ~line.rlike(MARKS))
    return F.array_join(own, "\n")


def _threads(replies: DataFrame, scratch: Scratch) -> DataFrame:
    """(conversation, turn, thread, depth): the first message up the replies and how far up it is,
    by pointer jumping: each round doubles the way that is known."""
    chains = scratch.write(
        replies.select("conversation", "turn", F.col("reply_to").alias("thread"), F.lit(1).cast("long").alias("depth")),
        "replies",
    )
    found, moving = [], chains
    while not moving.isEmpty():
        every = moving
        for done in found:
            every = every.unionByName(done)
        up = moving.alias("c").join(
            every.alias("p"),
            F.col("c.conversation").eqNullSafe(F.col("p.conversation"))
            & (F.col("c.thread") == F.col("p.turn")),
            "left",
        )
        step = scratch.write(
            up.select(
                "c.conversation",
                "c.turn",
                F.coalesce("p.thread", "c.thread").alias("thread"),
                (F.col("c.depth") + F.coalesce("p.depth", F.lit(0))).alias("depth"),
                F.col("p.thread").isNotNull().alias("moved"),
            ),
            "threads",
        )
        # What has come to its first message takes no part in further rounds.
        found.append(step.where("not moved").drop("moved"))
        moving = step.where("moved").drop("moved")
    threads = chains.where("false")
    for done in found:
        threads = threads.unionByName(done)
    return threads


def linked_passages(
    found: DataFrame, hot_rows: int = HOT_ROWS, span: int = SLICE_ROWS
) -> DataFrame:
    """(conversation, turn, level, source): per quoted passage, the latest message before that has it
    one depth less deep.

    Messages with a passage and messages that quote it lie in one order of turns; the last one that
    has it is carried along, so a passage that very many messages have or quote makes no pairs. Its
    rows are cut into slices of equal depth where they are more than a task should hold.
    """
    nothing = F.lit(None).cast(found.schema["turn"].dataType)
    stands = F.struct(F.col("level").alias("stands"), F.lit(1).alias("side"), F.col("turn").alias("has"))
    asked = F.struct((F.col("level") - 1).alias("stands"), F.lit(0).alias("side"), nothing.alias("has"))
    # What a message has, and what it asks for, in one shuffle.
    rows = found.select(
        "conversation", "hash", "turn", F.explode(F.array_compact(F.array(stands, F.when(F.col("level") > 0, asked)))).alias("_p")
    ).select("conversation", "hash", "turn", "_p.*")
    keys = ["conversation", "stands", "hash"]
    large = found.groupBy("conversation").count().where(F.col("count") > hot_rows // 2)
    if large.isEmpty():  # no passage of a conversation can have more rows than a task should hold
        together = Window.partitionBy(*keys).orderBy("turn", "side")
        before = together.rowsBetween(Window.unboundedPreceding, -1)
        known = rows.withColumns(
            {
                "source": F.last("has", ignorenulls=True).over(before),
                "_turn": F.lag("turn").over(together),
                "_side": F.lag("side").over(together),
            }
        )
        # Copies of a passage in a message ask once.
        again = F.col("_turn").eqNullSafe(F.col("turn")) & F.col("_side").eqNullSafe(F.col("side"))
        known = known.where(~again)
    else:
        known = last_known(rows.distinct(), keys, ["turn", "side"], "has", "source", hot_rows, span)
    return known.where("side = 0 and source is not null").select(
        "conversation", "turn", (F.col("stands") + 1).alias("level"), "source"
    )


def link_quotes(
    messages: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    text: str = "text",
    out: str = "reply",
    hot_rows: int = HOT_ROWS,
    span: int = SLICE_ROWS,
) -> DataFrame:
    """The messages with a struct: reply_to, thread, depth, n_quoted, deepest, body.

    A message replies to the earlier one that most of its passages of the least depth that links
    come from, the latest of equals; a message that quotes only deeper passages replies to the one
    that quoted them itself. `thread` is the first message up the replies, the message itself where
    it replies to none, and `depth` how many replies away that is. In the order of (thread, depth,
    turn) every message comes after the one it replies to. `body` is the text without quoted lines,
    `n_quoted` counts these, and `deepest` is the greatest depth of a line.

    Texts of any length are parsed whole. A null text has an empty body. Null conversations are one
    conversation; a null turn replies to nothing, is replied to by nothing and has a null thread.
    Rows that share conversation and turn are one message when links are counted, and each keeps
    its own body. Empty tables give empty results. A column called `out` is replaced; others pass
    through.
    """
    scratch = Scratch(messages.sparkSession, "quotes")
    found = scratch.write(passages(messages, conversation, turn, text), "passages")
    links = linked_passages(found, hot_rows, span)
    votes = links.groupBy("conversation", "turn", "level", "source").agg(F.count(F.lit(1)).alias("votes"))
    order = F.struct(-F.col("level"), F.col("votes"), F.col("source"))
    replies = scratch.write(
        votes.groupBy("conversation", "turn").agg(F.max_by("source", order).alias("reply_to")), "linked"
    )
    threads = _threads(replies, scratch)
    placed = (
        replies.alias("r")
        .join(
            threads.alias("t"),
            F.col("r.conversation").eqNullSafe(F.col("t.conversation"))
            & (F.col("r.turn") == F.col("t.turn")),
        )
        .select("r.conversation", "r.turn", "reply_to", "thread", "depth")
    )
    (side,) = fresh(messages, "_side")
    placed = small(packed(scratch.write(placed, "found"), side), [side])
    link = named(side)
    joined = messages.join(
        placed,
        named(conversation).eqNullSafe(link["conversation"]) & (named(turn) == link["turn"]),
        "left",
    )
    levels = F.transform(F.split(F.coalesce(named(text), F.lit("")), "\n"), level)
    kept = [c for c in messages.columns if c.lower() != out.lower()]
    return joined.select(
        *map(named, kept),
        F.struct(
            link["reply_to"].alias("reply_to"),
            F.coalesce(link["thread"], named(turn)).alias("thread"),
            F.when(named(turn).isNotNull(), F.coalesce(link["depth"], F.lit(0).cast("long"))).alias("depth"),
            F.size(F.filter(levels, lambda x: x > 0)).cast("long").alias("n_quoted"),
            F.array_max(levels).cast("long").alias("deepest"),
            without_quotes(named(text)).alias("body"),
        ).alias(out),
    )


def chat(found: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", out: str = "reply") -> DataFrame:
    """The messages as lines of chats: (conversation, thread, depth, turn, reply_to, role, content).

    Sorted by the first four, within the partitions that a conversation and thread is dealt to, a
    thread reads as a chat without quotes. Messages without a turn have no place in one and go.
    """
    s = named(out)
    rows = found.where(named(turn).isNotNull()).select(
        named(conversation).alias("conversation"),
        s["thread"].alias("thread"),
        s["depth"].alias("depth"),
        named(turn).alias("turn"),
        s["reply_to"].alias("reply_to"),
        named(role).alias("role"),
        s["body"].alias("content"),
    )
    order = ["conversation", "thread", "depth", "turn"]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order)
