"""A prefix trie of conversations, by burst tries: containers of suffixes beneath trie heads.

A turn is a digest of role and text. Conversations are cut into segments of 64 turns; equal
segments under one head are one row with counts, so copies cost one row. A node is named by 120
bits: the name of its segment's head, combined by exclusive or with a digest of the turns of the
segment up to it. So heads of long conversations come from a running combination, not from walking.

1. A container holds the suffixes beneath one head, the root's container all first segments. A
   container of more than CONTAINER turns bursts: each suffix moves beneath the node of its next
   turn, which becomes a head. Rounds take in what moved only.
2. The containers that remain are dealt out whole, sorted, and swept: neighbours' common turns tell
   where a path branches. What a sweep holds is one container.
3. Sums over subtrees go up from container to container by pointer doubling, in as many rounds as
   the logarithm of the heads above one another.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from syncloom.llm.common import Scratch, count_white_words, named, small, use_package

#: Turns of a segment, and hex digits of a turn's digest.
SEGMENT, DIGITS = 64, 32
#: A container of more turns bursts.
CONTAINER = 1 << 11
#: Segments whose digests one window combines; spans of them are combined before.
SPAN = 1 << 10
#: Conversation ids that one piece of a hashed list has.
LISTED = 1 << 13


# --- turns ---------------------------------------------------------------------------------------


def turn_digest(role: Column, text: Column) -> Column:
    """32 hex digits that stand for role and text; null counts as empty."""
    r, t = (F.coalesce(c.cast("string"), F.lit("")) for c in (role, text))
    return F.md5(F.concat(F.char_length(r).cast("string"), F.lit(":"), r, t))


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted rows: the number of each row in its conversation, as far as this part has it."""
    part, last, seen = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        column = batch.column("conversation")
        new = np.ones(n, dtype=bool)
        new[1:] = pc.not_equal(column.slice(1), column.slice(0, n - 1)).to_numpy(zero_copy_only=False)
        new[0] = last is None or last != column[0]
        starts = np.where(new, np.arange(n), np.iinfo(np.int64).min)
        if not new[0]:
            starts[0] = -seen  # goes on from the batch before
        number = np.arange(n) - np.maximum.accumulate(starts)
        last, seen = column[n - 1], int(number[-1]) + 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, part), pa.int32()), pa.array(number, pa.int64()), *batch.columns],
            ["part", "number", *batch.schema.names],
        )


def ordered_turns(
    turns: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """(conversation, position, turn, words): the turns' digests and words, numbered from 0.

    Turns are in the order of the turn column, null first, then of their digests; repeated rows are
    turns of their own. Null roles and texts count as empty; rows without a conversation belong to
    none and are left out. Rows are dealt into ranges of conversation and turn, so that a
    conversation of very many turns is the work of many tasks.
    """
    use_package(turns.sparkSession)
    scratch = Scratch(turns.sparkSession, "turns")
    rows = turns.where(named(conversation).isNotNull()).select(
        named(conversation).alias("conversation"),
        named(turn).alias("order"),
        turn_digest(named(role), named(text)).alias("turn"),
        count_white_words(named(text).cast("string")).alias("words"),
    )
    order = ["conversation", "order", "turn"]
    sorted_ = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("order")
    schema = T.StructType(
        [T.StructField("part", T.IntegerType()), T.StructField("number", T.LongType()), *sorted_.schema]
    )
    placed = scratch.write(sorted_.mapInArrow(_numbered, schema), "placed")
    # One row for each part: its last conversation, which may go on in the part that follows.
    lasts = placed.groupBy("part").agg(F.max(F.struct("conversation", "number")).alias("_l"))
    parts = Window.orderBy("part")
    inside = Window.partitionBy("_l.conversation").orderBy("part")
    going_on = lasts.select(
        F.lead("part").over(parts).alias("part"),
        F.col("_l.conversation").alias("conversation"),
        F.sum(F.col("_l.number") + 1).over(inside).alias("before"),
    )
    going_on = scratch.write(going_on.where("part is not null"), "going_on")
    joined = placed.join(small(going_on, ["conversation"]), ["part", "conversation"], "left")
    return scratch.write(
        joined.select(
            "conversation",
            (F.col("number") + F.coalesce("before", F.lit(0))).alias("position"),
            "turn",
            F.col("words").cast("int").alias("words"),
        ),
        "ordered",
    )


def conversations_of(ordered: DataFrame) -> DataFrame:
    """Each conversation once: the rows of their first turns."""
    return ordered.where("position = 0").select("conversation")


def with_openings(ordered: DataFrame, openings: DataFrame, most: int) -> DataFrame:
    """The turns of conversations whose first turns are replaced by another one's.

    `openings` has, once for each conversation, (conversation, base, taken): its first `taken`
    turns, `most` at most, go, and those of the conversation `base` come instead, fewer if that has
    fewer. So no row of `openings` makes more than `most` rows.
    """
    heads = ordered.where(F.col("position") < most)
    counted = heads.groupBy(F.col("conversation").alias("base")).agg(F.count(F.lit(1)).alias("had"))
    chosen = openings.join(counted, "base", "left").select(
        "conversation", "base", "taken", F.least("taken", F.coalesce("had", F.lit(0))).alias("got")
    )
    brought = (
        chosen.alias("o")
        .join(heads.alias("h"), F.col("o.base") == F.col("h.conversation"))
        .where(F.col("h.position") < F.col("o.got"))
        .select("o.conversation", "h.position", "h.turn", "h.words")
    )
    own = (
        ordered.join(chosen.select("conversation", "taken", "got"), "conversation")
        .where(F.col("position") >= F.col("taken"))
        .select(
            "conversation",
            (F.col("position") - F.col("taken") + F.col("got")).alias("position"),
            "turn",
            "words",
        )
    )
    return own.unionByName(brought)


# --- names ---------------------------------------------------------------------------------------


def digest(segment: int, ids: str) -> tuple[int, int]:
    """Two numbers of 60 bits."""
    found = hashlib.md5(f"{segment}:{ids}".encode()).hexdigest()
    return int(found[:15], 16), int(found[15:30], 16)


def _digest(segment: Column, ids: Column) -> tuple[Column, Column]:
    """The same as a pair of columns."""
    found = F.md5(F.concat(segment.cast("string"), F.lit(":"), ids))
    return tuple(F.conv(F.substring(found, at, 15), 16, 10).cast("long") for at in (1, 16))


def _name(ids: Column) -> list[Column]:
    """The name of a node: its segment's head and the turns of the segment up to it."""
    a, b = _digest(F.col("segment"), ids)
    return [F.col("head_a").bitwiseXOR(a), F.col("head_b").bitwiseXOR(b)]


# --- the sweep -----------------------------------------------------------------------------------

_NODE = (
    "a long, b long, box_a long, box_b long, top boolean, parent_least {key}, depth long, turn string, "
    "n long, least {key}, n_end long, children long, leaves long, saved long, "
    "below array<struct<a: long, b: long>>"
)


def sweep_container(rows: list[dict]) -> list[dict]:
    """The nodes of one container, whose rows are sorted by their turns.

    A row is a suffix with its members (n), the least of them, and how many end with it (n_end).
    Sums are over what the container has; `below` names the nodes beneath (or at) which a further
    segment begins.
    """
    first = rows[0]
    skip, segment, head = first["skip"], first["segment"], (first["head_a"], first["head_b"])
    nodes: list[dict] = []
    path: list[dict] = []
    before, depth_before = "", skip
    for row in rows:
        ids, length = row["ids"], len(row["ids"]) // DIGITS
        common = skip
        while common < min(depth_before, length) and (
            ids[common * DIGITS : (common + 1) * DIGITS] == before[common * DIGITS : (common + 1) * DIGITS]
        ):
            common += 1
        del path[common - skip :]
        for level in range(common + 1, length + 1):
            a, b = digest(segment, ids[: level * DIGITS])
            node = {
                "a": head[0] ^ a,
                "b": head[1] ^ b,
                "up": path[-1] if path else None,
                "depth": segment * SEGMENT + level,
                "turn": ids[(level - 1) * DIGITS : level * DIGITS],
                "words": row["words"][level - 1],
                "n": 0,
                "least": row["least"],
                "n_end": 0,
                "children": 0,
                "leaves": 0,
                "saved": 0,
                "below": [],
            }
            if path:
                path[-1]["children"] += 1
            nodes.append(node)
            path.append(node)
        for node in path:
            node["n"] += row["n"]
            node["least"] = min(node["least"], row["least"])
        path[-1]["n_end"] += row["n_end"]
        if row["n_end"] < row["n"] and length == SEGMENT:
            path[-1]["below"].append({"a": path[-1]["a"], "b": path[-1]["b"]})
        before, depth_before = ids, length
    for node in reversed(nodes):  # children come after their parents
        node["saved"] += (node["n"] - 1) * node.pop("words")
        node["leaves"] += node["n_end"] == node["n"]
        if (up := node["up"]) is not None:
            for c in ("saved", "leaves", "below"):
                up[c] += node[c]
    for node in nodes:
        up = node.pop("up")
        node |= {
            "box_a": first["box_a"],
            "box_b": first["box_b"],
            "top": up is None,
            "parent_least": up["least"] if up else None,
        }
    return nodes


def _sweep(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Containers one after the other; what is held is one of them and a batch."""
    held: list[dict] = []
    found: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and (held[0]["box_a"], held[0]["box_b"]) != (row["box_a"], row["box_b"]):
                found += sweep_container(held)
                held = []
                if len(found) >= 4096:
                    yield pa.RecordBatch.from_pylist(found, schema)
                    found = []
            held.append(row)
    if held:
        found += sweep_container(held)
    if found:
        yield pa.RecordBatch.from_pylist(found, schema)


# --- lists of members that end at a node -----------------------------------------------------------


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (a, b, conversation): texts of up to LISTED ids of a node, comma-joined."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        a, b = (batch.column(c).to_numpy() for c in ("a", "b"))
        new = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
        runs = np.append(np.flatnonzero(new), n)
        starts = np.concatenate([np.arange(i, j, LISTED) for i, j in zip(runs, runs[1:], strict=False)])
        ends = np.append(starts[1:], n)
        ids = batch.column("id").to_pylist()
        at = pa.array(starts)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("a").take(at),
                batch.column("b").take(at),
                batch.column("conversation").take(at),
                pa.array([",".join(ids[s:e]) for s, e in zip(starts, ends, strict=True)], pa.string()),
            ],
            ["a", "b", "first", "ids"],
        )


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of pieces sorted by (a, b, first): the digest of each node's list, piece after piece."""
    node, state = None, None

    def row(found: list) -> pa.RecordBatch:
        a, b, shas = zip(*found, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(shas, pa.string())],
            ["a", "b", "ends_sha256"],
        )

    for batch in batches:
        done = []
        columns = (batch.column(c).to_pylist() for c in ("a", "b", "ids"))
        for a, b, ids in zip(*columns, strict=True):
            if node == (a, b):
                state.update(b"," + ids.encode())
                continue
            if node is not None:
                done.append((*node, state.hexdigest()))
            node, state = (a, b), hashlib.sha256(ids.encode())
        if done:
            yield row(done)
    if node is not None:
        yield row([(*node, state.hexdigest())])


def ends_digests(ends: DataFrame) -> DataFrame:
    """(a, b, ends_sha256): SHA-256 of the ids of (a, b, conversation), ascending, comma-joined.

    Ids are dealt into ranges and joined to pieces there, so a node of very many ends is one row for
    some thousands of them where its digest, which takes bytes in order, is computed.
    """
    order = ["a", "b", "conversation"]
    rows = ends.withColumn("id", F.col("conversation").cast("string"))
    kind = ends.schema["conversation"].dataType
    pieces = (
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .mapInArrow(
            _listed,
            T.StructType(
                [
                    T.StructField("a", T.LongType()),
                    T.StructField("b", T.LongType()),
                    T.StructField("first", kind),
                    T.StructField("ids", T.StringType()),
                ]
            ),
        )
    )
    return (
        pieces.repartition("a", "b")
        .sortWithinPartitions("a", "b", "first")
        .mapInArrow(_hashed, "a long, b long, ends_sha256 string")
    )


# --- the trie ------------------------------------------------------------------------------------


class _Trie:
    def __init__(self, spark: SparkSession, container: int):
        self.spark, self.container = spark, container
        self.scratch = Scratch(spark, "trie")

    def segments(self, turns: DataFrame) -> DataFrame:
        """(conversation, segment, ids, words, length, goes_on, head_a, head_b)."""
        cell = F.struct("position", "turn", "words")
        cut = (
            turns.withColumn("segment", F.floor(F.col("position") / SEGMENT))
            .groupBy("conversation", "segment")
            .agg(F.sort_array(F.collect_list(cell)).alias("cells"))  # SEGMENT cells at most
        )
        made = self.scratch.write(
            cut.select(
                "conversation",
                "segment",
                F.array_join(F.col("cells.turn"), "").alias("ids"),
                F.col("cells.words").alias("words"),
                F.size("cells").alias("length"),
            ),
            "segments",
        )
        later = self.scratch.write(
            made.where("segment > 0").select("conversation", F.col("segment") - 1), "later"
        ).toDF("conversation", "segment")
        follows = later.withColumn("goes_on", F.lit(True))
        marked = made.join(follows, ["conversation", "segment"], "left").withColumn(
            "goes_on", F.coalesce("goes_on", F.lit(False))
        )
        heads = self.heads(marked)
        return self.scratch.write(
            marked.join(heads, ["conversation", "segment"], "left")
            .withColumn("head_a", F.coalesce("head_a", F.lit(0).cast("long")))
            .withColumn("head_b", F.coalesce("head_b", F.lit(0).cast("long"))),
            "headed",
        )

    def heads(self, segments: DataFrame) -> DataFrame:
        """(conversation, segment, head_a, head_b) of segments with others before them.

        Digests of the segments before are combined: of spans first, then inside a span.
        """
        a, b = _digest(F.col("segment"), F.col("ids"))
        full = segments.where("goes_on").select(
            "conversation", "segment", F.floor(F.col("segment") / SPAN).alias("span"), a.alias("da"), b.alias("db")
        )
        full = self.scratch.write(full, "full")
        earlier = Window.partitionBy("conversation").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
        spans = (
            full.groupBy("conversation", "span")
            .agg(F.bit_xor("da").alias("sa"), F.bit_xor("db").alias("sb"))
            .select(
                "conversation",
                "span",
                *[F.coalesce(F.bit_xor(c).over(earlier), F.lit(0)).alias(c) for c in ("sa", "sb")],
            )
        )
        inside = Window.partitionBy("conversation", "span").orderBy("segment")
        return (
            full.select(
                "conversation",
                "span",
                (F.col("segment") + 1).alias("segment"),
                F.bit_xor("da").over(inside).alias("ia"),
                F.bit_xor("db").over(inside).alias("ib"),
            )
            .join(spans, ["conversation", "span"])
            .select(
                "conversation",
                "segment",
                F.col("ia").bitwiseXOR(F.col("sa")).alias("head_a"),
                F.col("ib").bitwiseXOR(F.col("sb")).alias("head_b"),
            )
        )

    def suffixes(self, segments: DataFrame) -> DataFrame:
        """Distinct segments under their heads, in the containers of these heads."""
        grouped = segments.groupBy("segment", "head_a", "head_b", "ids").agg(
            F.first("words").alias("words"),  # the same in all, as turns stand for their texts
            F.first("length").alias("length"),
            F.count(F.lit(1)).alias("n"),
            F.min("conversation").alias("least"),
            F.sum(F.when(F.col("goes_on"), 0).otherwise(1)).cast("long").alias("n_end"),
        )
        return self.scratch.write(
            grouped.withColumns(
                {"box_a": F.col("head_a"), "box_b": F.col("head_b"), "skip": F.lit(0)}
            ),
            "suffixes",
        )

    def burst(self, rows: DataFrame) -> tuple[list[DataFrame], list[DataFrame]]:
        """Containers that are small enough, and the nodes that came of the others."""
        parked, nodes = [], []
        box = ["box_a", "box_b"]
        while True:
            sizes = rows.groupBy(*box).agg(F.sum(F.col("length") - F.col("skip")).alias("_turns"))
            large = self.scratch.write(
                sizes.where(F.col("_turns") > self.container).select(*box), "large"
            )
            if large.isEmpty():
                return [*parked, rows], nodes
            large = small(large, box)
            parked.append(rows.join(large, box, "left_anti"))
            level = F.col("skip") + 1
            a, b = _name(F.substring(F.col("ids"), F.lit(1), level * DIGITS))
            moved = self.scratch.write(
                rows.join(large, box, "left_semi").withColumns({"a": a, "b": b, "level": level}), "moved"
            )
            nodes.append(
                self.scratch.write(
                    moved.groupBy("a", "b").agg(
                        F.first("box_a").alias("box_a"),
                        F.first("box_b").alias("box_b"),
                        F.first(F.col("segment") * SEGMENT + F.col("level")).alias("depth"),
                        F.first(
                            F.substring(F.col("ids"), F.col("skip") * DIGITS + 1, F.lit(DIGITS))
                        ).alias("turn"),
                        F.first(F.element_at("words", F.col("level"))).alias("words"),
                        F.sum("n").alias("n"),
                        F.min("least").alias("least"),
                        F.sum(F.when(F.col("length") == F.col("level"), F.col("n_end")).otherwise(0)).alias("n_end"),
                    ),
                    "burst",
                )
            )
            rest = moved.where(F.col("length") > F.col("level"))
            rows = rest.withColumns({"box_a": F.col("a"), "box_b": F.col("b"), "skip": F.col("level")}).select(
                *rows.columns
            )

    def swept(self, parked: list[DataFrame]) -> DataFrame:
        rows = parked[0]
        for other in parked[1:]:
            rows = rows.unionByName(other)
        kind = rows.schema["least"].dataType
        ddl = _NODE.format(key=kind.simpleString())
        arrow = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in T.StructType.fromDDL(ddl)])
        box = ["box_a", "box_b"]
        chosen = rows.select(*box, "skip", "segment", "head_a", "head_b", "ids", "words", "n", "least", "n_end")
        return self.scratch.write(
            chosen.repartition(*box).sortWithinPartitions(*box, "ids").mapInArrow(lambda x: _sweep(x, arrow), ddl),
            "swept",
        )

    def totals(self, values: DataFrame, edges: DataFrame) -> DataFrame:
        """(a, b, leaves, saved) of all that is beneath a container, by pointer doubling."""
        rows = self.scratch.write(values.join(edges, ["a", "b"], "left"), "heads")
        while not (moving := rows.where("up_a is not null")).isEmpty():
            sums = moving.groupBy(F.col("up_a").alias("a"), F.col("up_b").alias("b")).agg(
                F.sum("leaves").alias("_l"), F.sum("saved").alias("_s")
            )
            # The root has none above it, so most of a shallow trie needs no look-up.
            above = rows.where("up_a is not null").select(
                F.col("a").alias("up_a"), F.col("b").alias("up_b"), F.col("up_a").alias("_a"), F.col("up_b").alias("_b")
            )
            rows = self.scratch.write(
                rows.join(sums, ["a", "b"], "left")
                .join(above, ["up_a", "up_b"], "left")
                .select(
                    "a",
                    "b",
                    (F.col("leaves") + F.coalesce("_l", F.lit(0))).alias("leaves"),
                    (F.col("saved") + F.coalesce("_s", F.lit(0))).alias("saved"),
                    "children",
                    F.col("_a").alias("up_a"),
                    F.col("_b").alias("up_b"),
                ),
                "heads",
            )
        return rows.select("a", "b", "leaves", "saved", "children")

    def nodes(self, conversations: DataFrame, turns: DataFrame) -> tuple[DataFrame, DataFrame]:
        segments = self.segments(turns)
        parked, levels = self.burst(self.suffixes(segments))
        swept = self.swept(parked)
        kind = swept.schema["least"].dataType.simpleString()
        bursts = self.spark.createDataFrame(
            [],
            f"a long, b long, box_a long, box_b long, depth long, turn string, words int, n long, least {kind}, n_end long",
        )
        if levels:
            bursts = levels[0]
            for other in levels[1:]:
                bursts = bursts.unionByName(other)
        own = (F.col("n") - 1) * F.col("words")
        ended = (F.col("n") == F.col("n_end")).cast("long")
        up = [F.col("box_a").alias("a"), F.col("box_b").alias("b")]
        one = F.lit(1).cast("long")
        values = (
            swept.where("top")
            .select(*up, "leaves", "saved", one.alias("children"))
            .unionByName(bursts.select(*up, ended.alias("leaves"), own.alias("saved"), one.alias("children")))
            .groupBy("a", "b")
            .agg(*[F.sum(c).alias(c) for c in ("leaves", "saved", "children")])
        )
        edge = ["a", "b", F.col("box_a").alias("up_a"), F.col("box_b").alias("up_b")]
        gates = swept.where(F.array_contains("below", F.struct("a", "b")))
        edges = bursts.select(*edge).unionByName(gates.select(*edge))
        totals = self.scratch.write(self.totals(values, edges), "totals")
        members = conversations.agg(
            F.count(F.lit(1)).alias("n"), F.min("conversation").alias("least")
        ).where("n > 0")
        zero = F.lit(0).cast("long")
        root = members.select(zero.alias("a"), zero.alias("b"), "n", "least")
        leasts = (
            bursts.select("a", "b", "least").unionByName(gates.select("a", "b", "least")).unionByName(root.select("a", "b", "least"))
        )
        above = leasts.select(
            F.col("a").alias("box_a"), F.col("b").alias("box_b"), F.col("least").alias("_above")
        )
        beneath = totals.select("a", "b", *[F.col(c).alias(f"_{c}") for c in ("leaves", "saved", "children")])
        add = lambda c: F.coalesce(F.col(f"_{c}"), zero)
        columns = ["a", "b", "least", "depth", "parent", "turn", "n", "n_end", "children", "leaves", "saved"]

        from_bursts = (
            bursts.join(above, ["box_a", "box_b"])
            .join(beneath, ["a", "b"], "left")
            .withColumns(
                {
                    "parent": F.col("_above"),
                    "children": add("children"),
                    "leaves": ended + add("leaves"),
                    "saved": own + add("saved"),
                }
            )
            .select(*columns)
        )
        from_root = (
            root.join(beneath, ["a", "b"], "left")
            .withColumns(
                {
                    "depth": zero,
                    "parent": F.lit(None).cast(kind),
                    "turn": F.lit(None).cast("string"),
                    "n_end": zero,
                    "children": add("children"),
                    "leaves": F.when(add("children") == 0, one).otherwise(add("leaves")),
                    "saved": add("saved"),
                }
            )
            .select(*columns)
        )
        tops = (
            swept.where("top").join(above, ["box_a", "box_b"]).withColumn("parent", F.col("_above"))
        )
        inner = swept.where("not top").withColumn("parent", F.col("parent_least"))
        from_sweep = tops.drop("_above").unionByName(inner)
        if not swept.where(F.size("below") > 0).isEmpty():
            from_sweep = self.with_later_segments(from_sweep, beneath)
        found = from_sweep.select(*columns).unionByName(from_bursts).unionByName(from_root)
        a, b = _name(F.col("ids"))
        ends = segments.where("not goes_on").select(a.alias("a"), b.alias("b"), "conversation")
        turnless = conversations.join(segments.where("segment = 0"), "conversation", "left_anti")
        ends = ends.unionByName(turnless.select(zero.alias("a"), zero.alias("b"), "conversation"))
        return found, ends

    def with_later_segments(self, nodes: DataFrame, beneath: DataFrame) -> DataFrame:
        """Nodes with what hangs beneath further segments added; a row of 64 turns has 64 such pairs."""
        pairs = nodes.where(F.size("below") > 0).select(
            F.col("a").alias("na"), F.col("b").alias("nb"), F.explode("below").alias("_u")
        )
        sums = (
            pairs.join(beneath, (F.col("_u.a") == beneath["a"]) & (F.col("_u.b") == beneath["b"]))
            .groupBy("na", "nb")
            .agg(
                F.sum("_leaves").alias("_leaves"),
                F.sum("_saved").alias("_saved"),
                F.sum(
                    F.when((F.col("_u.a") == F.col("na")) & (F.col("_u.b") == F.col("nb")), F.col("_children")).otherwise(0)
                ).alias("_children"),
            )
            .withColumnsRenamed({"na": "a", "nb": "b"})
        )
        joined = nodes.join(sums, ["a", "b"], "left")
        return joined.withColumns(
            {c: F.col(c) + F.coalesce(f"_{c}", F.lit(0)) for c in ("children", "leaves", "saved")}
        ).drop("_children", "_leaves", "_saved")


def prefix_trie(
    conversations: DataFrame, turns: DataFrame, container: int = CONTAINER
) -> tuple[DataFrame, DataFrame]:
    """The nodes of the trie, and which node each conversation ends at.

    `conversations` has each (conversation) once, also those without turns; `turns` has their
    (conversation, position, turn, words), numbered from 0 without gaps, as `ordered_turns` gives.

    Nodes: a and b (the name; 0, 0 for the root), least (member), depth, parent (the parent's least
    member, null for the root), turn (digest of the last one), n (members), children, leaves
    (childless nodes of the subtree), saved (words of the subtree's last turns that sharing saves).
    Ends: a, b, conversation. No conversations make no nodes, conversations without turns the root.
    """
    use_package(turns.sparkSession)
    trie = _Trie(turns.sparkSession, container)
    found, ends = trie.nodes(conversations, turns)
    return found.drop("n_end"), ends
