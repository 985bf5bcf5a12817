"""N-gram Jaccard join: size-banded tiles, bitmap bounds, then exact intersections.

A document is the set of its distinct word shingles, kept as 64-bit hashes in a sorted array. Equal
sets are one class. Two classes link when their Jaccard similarity reaches the threshold; the
result is the component of each document.

1. A first pass over the texts gives each document's set key and size, and the shingles that many
   documents share. The most frequent ones, a list of bounded length, sort behind all others.
2. In that order a class shows its first (1 - t) n + 1 shingles: two classes that link have one of
   them in common. Shingles are dealt out in ranges; those of one class alone go no further.
3. Classes that a shingle brings together are a tile, cut by size bands: linked sizes lie in one
   band or in two next to each other. Each class carries a bitmap of its hashes, folded to a short
   signature; pairs that this lets pass are looked at with the whole bitmap. Bits that only one side
   has stand for different shingles, which bounds the overlap from above.
4. First, for a few rounds, each class is paired with a few neighbours in a seeded order of its
   tiles, which joins nearly all of a group of copies by some pairs for each row. Tiles whose classes
   are one component by then need no more pairs. In the others, classes of different components
   are compared, in blocks.
5. Pairs that the bound lets pass are intersected exactly, the most similar partners of each class
   first, until no untested pair joins two components. So a group of copies is never expanded
   into all its pairs, and no link that changes a component is left out.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from syncloom.llm.common import Scratch, fresh, named, packed, row_key, small, use_package
from syncloom.llm.components import grown

SHINGLE, PERCENT = 5, 80
#: Length of the list of frequent shingles: 512 KB in each task, whatever the corpus.
FREQUENT = 1 << 16
#: A tile with more classes is compared block by block.
BLOCK = 2048
#: Partners of a class that the first exact round takes; later rounds take four times as many.
FIRST_PARTNERS = 16
#: Rounds that pair classes with a few neighbours before all that is left apart is compared, how
#: many neighbours of a class are looked at, and how many of these, the best by bound, are tested.
TURNS, NEAR, TESTED = 4, 8, 3


def _finish(x: np.ndarray) -> np.ndarray:
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


#: An odd multiplier for each place of a shingle; unrelated ones, so that no swap of words cancels.
_MIX = _finish(np.arange(1, 65, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def shingle_set(text: bytes | None, width: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the shingles; bytes lower and split as the contract's words."""
    words = text.lower().split() if text else []
    n = len(words)
    if not n:
        return np.empty(0, dtype=np.uint64)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=n)
    size = min(n, width)
    total = np.full(n - size + 1, size, dtype=np.uint64)
    for i in range(size):
        total += hashes[i : n - size + 1 + i] * _MIX[i]
    found = _finish(total)
    found.sort()
    new = np.ones(len(found), dtype=bool)
    np.not_equal(found[1:], found[:-1], out=new[1:])
    return found if new.all() else found[new]


def set_key(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _texts(batch: pa.RecordBatch) -> Iterator[bytes | None]:
    column = batch.column("text").cast(pa.binary())
    return (value.as_py() for value in column)


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 2048) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def _survey(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Rows of documents (n, set key), and rows of shingles that several rows of a batch share."""
    for batch in _slices(batches):
        sets = [shingle_set(t, width) for t in _texts(batch)]
        keys = [set_key(s) if len(s) else None for s in sets]
        distinct = {k: s for k, s in zip(keys, sets, strict=True) if k is not None}
        shared, counts = np.unique(
            np.concatenate([np.empty(0, np.uint64), *distinct.values()]), return_counts=True
        )
        shared, counts = shared[counts > 1], counts[counts > 1]
        rows, more = len(sets), len(shared)
        yield pa.RecordBatch.from_pydict(
            {
                "row": pa.concat_arrays([batch.column("row"), pa.nulls(more, pa.binary())]),
                "n": pa.array([*map(len, sets), *([None] * more)], pa.int32()),
                "key": pa.array([*keys, *([None] * more)], pa.binary()),
                "shingle": pa.concat_arrays([pa.nulls(rows, pa.int64()), pa.array(shared.view(np.int64))]),
                "holders": pa.concat_arrays([pa.nulls(rows, pa.int64()), pa.array(counts.astype(np.int64))]),
            }
        )


def prefix_length(n: int, percent: int) -> int:
    """So many first shingles of a set of n meet those of every set it links with."""
    return n - -(-percent * n // 100) + 1


def bitmap_bits(n: int) -> int:
    """A power of two of four bits or more for each shingle, 32,768 at most."""
    return min(1 << 15, max(64, 1 << (4 * n - 1).bit_length()))


def bitmap(shingles: np.ndarray) -> np.ndarray:
    bits = bitmap_bits(len(shingles))
    flags = np.zeros(bits, dtype=np.uint8)
    flags[(shingles & np.uint64(bits - 1)).astype(np.int64)] = 1
    return np.packbits(flags, bitorder="little").view(np.uint64)


def signature(words: np.ndarray, n: int) -> np.ndarray:
    """A bitmap of up to 1,024 bits as it is, a longer one folded to one or two bits for each shingle:
    enough to tell nearly all pairs apart. In a shorter one chance would let too many pass."""
    return _fold(words, min(len(words), max(16, (1 << max(n - 1, 1).bit_length()) // 64)))


def _profile(
    batches: Iterator[pa.RecordBatch], width: int, percent: int, frequent: np.ndarray
) -> Iterator[pa.RecordBatch]:
    """For the row that stands for each class: its bitmap, its signature and its first shingles."""
    for batch in batches:
        ids, bitmaps, signs, prefixes, kept = [], [], [], [], []
        for node, key, text in zip(
            batch.column("node").to_pylist(), batch.column("key").to_pylist(), _texts(batch), strict=True
        ):
            shingles = shingle_set(text, width)
            if not len(shingles) or set_key(shingles) != key:
                continue  # another text under the same id
            length = prefix_length(len(shingles), percent)
            at = np.searchsorted(frequent, shingles)
            common = frequent[np.minimum(at, len(frequent) - 1)] == shingles if len(frequent) else at < 0
            rare = shingles[~common]
            first = rare[:length] if len(rare) >= length else np.concatenate([rare, shingles[common]])[:length]
            ids.append(node)
            kept.append(len(shingles))
            words = bitmap(shingles)
            bitmaps.append(words.tobytes())
            signs.append(signature(words, len(shingles)).tobytes())
            prefixes.append(first.view(np.int64))
        yield pa.RecordBatch.from_pydict(
            {
                "node": pa.array(ids, pa.int64()),
                "n": pa.array(kept, pa.int32()),
                "bits": pa.array(bitmaps, pa.binary()),
                "sign": pa.array(signs, pa.binary()),
                "prefix": pa.array(prefixes, pa.list_(pa.int64())),
            }
        )


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray, int]]:
    """Sorted batches, each with the last row before it, whether a row is of the shingle of the row
    above, and the number of rows that were there before."""
    above: pa.RecordBatch | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([above, batch] if above is not None else [batch])
        shingles = rows.column("shingle").to_numpy()
        same = np.concatenate([[False], shingles[1:] == shingles[:-1]])
        yield rows, same, int(above is not None)
        above = batch.slice(batch.num_rows - 1)


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by shingle: those whose shingle another row has.

    The first and the last run of a partition may go on next door, and stay.
    """
    held: tuple[pa.Table, bool] | None = None  # the last row, and whether it stays for sure
    first = True
    for rows, same, known in _runs(batches):
        follow = np.concatenate([same[1:], [False]])
        keep = same | follow
        if first:
            keep[0] = True
            first = False
        if held is not None and (held[1] or keep[0]):
            yield from held[0].to_batches()
        last = rows.num_rows - 1
        yield from rows.slice(known, last - known).filter(pa.array(keep[known:last])).to_batches()
        sure = bool(keep[last]) if last >= known else False
        held = (rows.slice(last), sure)
    if held is not None:
        yield from held[0].to_batches()


def _neighbours(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by shingle: (node, other) for rows next to each other whose sizes can link
    and whose components differ."""
    for rows, same, _ in _runs(batches):
        n = rows.column("n").to_numpy().astype(np.int64)
        node, component = rows.column("node").to_numpy(), rows.column("component").to_numpy()
        fits = 100 * np.minimum(n[1:], n[:-1]) >= percent * np.maximum(n[1:], n[:-1])
        at = np.flatnonzero(same[1:] & fits & (component[1:] != component[:-1])) + 1
        yield pa.RecordBatch.from_pydict(
            {"node": pa.array(node[at], pa.int64()), "other": pa.array(node[at - 1], pa.int64())}
        )


def _words(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(v.as_py(), dtype=np.uint64) for v in column]


def _fold(words: np.ndarray, size: int) -> np.ndarray:
    """A bitmap of fewer bits: positions are taken modulo a smaller power of two."""
    return words if len(words) == size else np.bitwise_or.reduce(words.reshape(-1, size), axis=0)


def needed(a, b, percent: int):
    """The least overlap of sets of sizes a and b that link."""
    return -(-percent * (a + b) // (100 + percent))


def overlap_bound(a: np.ndarray, b: np.ndarray, na, nb):
    """No pair of sets with these bitmaps shares more."""
    only_a = np.bitwise_count(a & ~b).sum(axis=-1, dtype=np.int64)
    only_b = np.bitwise_count(b & ~a).sum(axis=-1, dtype=np.int64)
    return np.minimum(na - only_a, nb - only_b)


def _bound_pairs(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Of pairs (a, b) with sizes and bitmaps, those that may link, with their bound."""
    for batch in batches:
        na, nb = (batch.column(c).to_numpy().astype(np.int64) for c in ("na", "nb"))
        bits = _words(batch.column("bits_a")) + _words(batch.column("bits_b"))
        i = np.arange(len(na))
        bound = _folded_bounds(bits, i, i + len(na), np.concatenate([na, nb]))
        mask = pa.array(bound >= needed(na, nb, percent))
        yield pa.RecordBatch.from_pydict(
            {
                "a": batch.column("a").filter(mask),
                "b": batch.column("b").filter(mask),
                "bound": pa.array((bound * 1000 // (na + nb - bound)).astype(np.int32)).filter(mask),
            }
        )


def _folded_bounds(bits: list[np.ndarray], i, j, n) -> np.ndarray:
    """Overlap bounds of the pairs (i, j) of rows, in pieces of a few megabytes."""
    lengths = np.array([len(b) for b in bits])
    size = np.minimum(lengths[i], lengths[j])
    bound = np.zeros(len(i), dtype=np.int64)
    for s in np.unique(size):
        pairs = np.flatnonzero(size == s)
        used = np.unique(np.concatenate([i[pairs], j[pairs]]))
        table = np.stack([_fold(bits[r], s) for r in used])
        step = max(1, (1 << 19) // int(s))
        for start in range(0, len(pairs), step):
            part = pairs[start : start + step]
            x, y = np.searchsorted(used, i[part]), np.searchsorted(used, j[part])
            bound[part] = overlap_bound(table[x], table[y], n[i[part]], n[j[part]])
    return bound


def _tile_pairs(rows: pa.Table, percent: int) -> pa.RecordBatch | None:
    """Pairs of whole tiles that may link and whose components differ.

    Rows are sorted by tile and size. Row r meets row r + d for d = 1, 2, ... as long as that row
    is of its tile and not too large; both only end once, so the rows that go on get fewer. Visitors
    meet no visitors, and rows of a tile of two blocks meet the other block only.
    """
    column = lambda name: rows.column(name).to_numpy()
    tiles = np.stack([column(c).astype(np.int64) for c in ("shingle", "band", "left", "right")])
    number = np.cumsum(np.concatenate([[0], np.any(tiles[:, 1:] != tiles[:, :-1], axis=0)]))
    n, node, component = column("n").astype(np.int64), column("node"), column("component")
    home, block = column("home").astype(bool), column("block")
    split = column("left") != column("right")
    # As the smaller one of a pair a row needs to be met by its index part only.
    index = n - -(-2 * percent * n // (100 + percent)) + 1
    shows = column("place") < index
    bits = _words(rows.column("bits").combine_chunks())
    found: set[tuple[int, int, int]] = set()
    waiting: list[tuple[np.ndarray, np.ndarray]] = []

    def flush():
        if not waiting:
            return
        i, j = (np.concatenate(x) for x in zip(*waiting, strict=True))
        waiting.clear()
        low, high = np.minimum(node[i], node[j]), np.maximum(node[i], node[j])
        _, once = np.unique(np.stack([low, high]), axis=1, return_index=True)
        i, j, low, high = i[once], j[once], low[once], high[once]
        bound = _folded_bounds(bits, i, j, n)
        good = bound >= needed(n[i], n[j], percent)
        share = bound[good] * 1000 // (n[i][good] + n[j][good] - bound[good])
        found.update(zip(low[good].tolist(), high[good].tolist(), share.tolist(), strict=True))

    active, d, pending = np.flatnonzero(shows), 1, 0
    while len(active):
        active = active[active + d < len(n)]
        other = active + d
        goes_on = (number[active] == number[other]) & (100 * n[active] >= percent * n[other])
        active, other = active[goes_on], other[goes_on]
        meet = (component[active] != component[other]) & (home[active] | home[other])
        meet &= ~split[active] | (block[active] != block[other])
        if meet.any():
            waiting.append((active[meet], other[meet]))
            pending += int(meet.sum())
            if pending > 500_000:
                flush()
                pending = 0
        d += 1
    flush()
    if not found:
        return None
    a, b, bound = (list(x) for x in zip(*sorted(found), strict=True))
    return pa.RecordBatch.from_pydict(
        {"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "bound": pa.array(bound, pa.int32())}
    )


def _tiles_in_turn(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Whole tiles at a time; what is held is a batch and one tile, of two blocks at most."""
    tile = ("shingle", "band", "left", "right")
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in tile])
        last = keys[:, -1]
        # The last tile may go on in the next batch.
        start = int(np.argmax(np.all(keys == last[:, None], axis=0)))
        before = [held[-1].column(c)[held[-1].num_rows - 1].as_py() for c in tile] if held else None
        if start or (before is not None and before != last.tolist()):
            done = [*held, batch.slice(0, start)]
            if (pairs := _tile_pairs(pa.Table.from_batches(done), percent)) is not None:
                yield pairs
            held = [batch.slice(start)]
        else:
            held.append(batch)
    if held and (pairs := _tile_pairs(pa.Table.from_batches(held), percent)) is not None:
        yield pairs


def _exact(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Of pairs with both arrays, those that link."""
    for batch in batches:
        good = []
        for x, y in zip(_words(batch.column("set_a")), _words(batch.column("set_b")), strict=True):
            shared = len(np.intersect1d(x, y, assume_unique=True))
            good.append(100 * shared >= percent * (len(x) + len(y) - shared))
        mask = pa.array(good, pa.bool_())
        yield pa.RecordBatch.from_pydict(
            {"a": batch.column("a").filter(mask), "b": batch.column("b").filter(mask)}
        )


def _sets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, arrays = [], []
        for node, key, text in zip(
            batch.column("node").to_pylist(), batch.column("key").to_pylist(), _texts(batch), strict=True
        ):
            shingles = shingle_set(text, width)
            if len(shingles) and set_key(shingles) == key:
                ids.append(node)
                arrays.append(shingles.tobytes())
        yield pa.RecordBatch.from_pydict(
            {"node": pa.array(ids, pa.int64()), "shingles": pa.array(arrays, pa.binary())}
        )


class _Join:
    """One run of the join over a table (row, text), with its scratch tables."""

    def __init__(self, spark: SparkSession, texts: DataFrame, width: int, percent: int):
        self.scratch, self.texts = Scratch(spark, "jaccard"), texts
        self.width, self.percent = width, percent
        self.repeated = False

    def survey(self) -> tuple[DataFrame, np.ndarray]:
        width = self.width
        rows = self.scratch.write(
            self.texts.mapInArrow(
                lambda b: _survey(b, width),
                "row binary, n int, key binary, shingle long, holders long",
            ),
            "survey",
        )
        top = (
            rows.where("shingle is not null")
            .groupBy("shingle")
            .agg(F.sum("holders").alias("holders"))
            .orderBy(F.desc("holders"), "shingle")
            .limit(FREQUENT)
            .select("shingle")
        )
        frequent = np.array([r[0] for r in top.collect()], dtype=np.int64).view(np.uint64)
        members = rows.where("shingle is null").select("row", "n", "key")
        twice = members.groupBy("row").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
        self.repeated = not twice.isEmpty()
        return members, np.sort(frequent)

    def classes(self, members: DataFrame) -> DataFrame:
        """(node, key, row): one row for each set that is not empty, numbered."""
        grouped = members.where("key is not null").groupBy("key").agg(F.min("row").alias("row"))
        return self.scratch.write(
            grouped.select(F.monotonically_increasing_id().alias("node"), "key", "row"), "classes"
        )

    def of_class(self, classes: DataFrame, work, schema: str) -> DataFrame:
        """What the worker makes of the text that stands for each class."""
        chosen = small(packed(classes, "_class"), ["_class"])
        texts = self.texts.join(chosen, F.col("row") == F.col("_class.row")).select(
            F.col("_class.node").alias("node"), F.col("_class.key").alias("key"), "text"
        )
        made = texts.mapInArrow(work, schema)
        # Rows that agree in key and text stand for their class together.
        return made.dropDuplicates(["node"]) if self.repeated else made

    def tiles(self, profiles: DataFrame) -> DataFrame:
        """(shingle, node, n, place): first shingles that more than one class has."""
        shown = profiles.select("node", "n", F.posexplode("prefix").alias("place", "shingle"))
        ranged = (
            shown.select("shingle", "node", "n", "place")
            .repartitionByRange("shingle", "node")
            .sortWithinPartitions("shingle", "node")
        )
        return self.scratch.write(
            ranged.mapInArrow(_repeated, "shingle long, node long, n int, place int"), "tiles"
        )

    def marked(self, tiles: DataFrame, labels: DataFrame) -> DataFrame:
        """The rows of tiles with their components."""
        return tiles.join(labels, "node", "left").withColumn(
            "component", F.coalesce("component", "node")
        )

    def near_pairs(self, tiles: DataFrame, labels: DataFrame, turn: int) -> DataFrame:
        """A few pairs for each class with others next to it in its tiles, in a seeded order."""
        percent = self.percent
        order = F.xxhash64("shingle", "node", F.lit(turn)).alias("order")
        rows = self.marked(tiles, labels).select("shingle", order, "node", "n", "component")
        ranged = rows.repartitionByRange("shingle", "order").sortWithinPartitions("shingle", "order")
        found = ranged.mapInArrow(lambda b: _neighbours(b, percent), "node long, other long")
        drawn = Window.partitionBy("node").orderBy(F.xxhash64("node", "other"), "other")
        some = found.distinct().withColumn("_r", F.row_number().over(drawn)).where(F.col("_r") <= NEAR)
        return some.select(
            F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")
        ).distinct()

    def screened(self, pairs: DataFrame, profiles: DataFrame) -> DataFrame:
        """Pairs that short signatures let pass, and of these the ones that full bitmaps do."""
        return self.bound(self.bound(pairs, profiles, "sign").select("a", "b"), profiles, "bits")

    def bound(self, pairs: DataFrame, profiles: DataFrame, bits: str) -> DataFrame:
        percent = self.percent
        sides = pairs.join(
            profiles.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col(bits).alias("bits_a")), "a"
        ).join(
            profiles.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col(bits).alias("bits_b")), "b"
        )
        return sides.where(
            (100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
        ).mapInArrow(lambda x: _bound_pairs(x, percent), "a long, b long, bound int")

    def verify(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        percent = self.percent
        both = pairs.join(
            sets.select(F.col("node").alias("a"), F.col("shingles").alias("set_a")), "a"
        ).join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("set_b")), "b")
        return both.mapInArrow(lambda x: _exact(x, percent), "a long, b long")

    def verified(self, pairs: DataFrame, classes: DataFrame) -> DataFrame:
        """Pairs that link, by the sets of their classes; these are not kept."""
        width = self.width
        nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        asked = self.scratch.write(classes.join(nodes, "node", "left_semi"), "asked")
        sets = self.of_class(asked, lambda b: _sets(b, width), "node long, shingles binary")
        with self.scratch.held(sets, "sets") as written:
            return self.scratch.write(self.verify(pairs, written), "linked")

    def cross_pairs(self, tiles: DataFrame, profiles: DataFrame, labels: DataFrame) -> DataFrame:
        """Pairs of different components that share a tile and that the signatures let pass."""
        percent = self.percent
        marked = self.marked(tiles, labels)
        open_ = (
            marked.groupBy("shingle")
            .agg(
                F.min("component").alias("_low"),
                F.max("component").alias("_high"),
                F.count(F.lit(1)).alias("_m"),
            )
            .where(F.col("_low") < F.col("_high"))
            .select("shingle", F.ceil(F.col("_m") / BLOCK).cast("int").alias("blocks"))
        )
        log = math.log(100 / percent)
        own = F.floor(F.log(F.col("n")) / log + 1e-9).cast("long")
        rows = marked.join(open_, "shingle").withColumns(
            {"own": own, "block": F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")}
        )
        # At home in its band, a visitor in the next; a large tile is met by pairs of blocks.
        index = F.col("n") - F.ceil(F.col("n") * (2 * percent) / F.lit(100 + percent)) + 1
        others = F.sequence(F.lit(0), F.col("blocks") - 1)
        tile = ["shingle", "band", "left", "right"]
        dealt = (
            rows.withColumn("band", F.explode(F.array("own", F.col("own") + 1)))
            .withColumn("home", F.col("band") == F.col("own"))
            # A visitor is the smaller one of its pairs, so its index part will do.
            .where(F.col("home") | (F.col("place") < index))
            .withColumn("other", F.explode(others))
            .withColumns(
                {"left": F.least("block", "other"), "right": F.greatest("block", "other")}
            )
            .select(*tile, "node", "n", "place", "component", "home", "block")
        )
        # Only tiles that hold two components go on, and only their rows get signatures.
        mixed = (
            dealt.groupBy(*tile)
            .agg(F.min("component").alias("_low"), F.max("component").alias("_high"))
            .where(F.col("_low") < F.col("_high"))
            .select(*tile)
        )
        dealt = self.scratch.write(dealt.join(mixed, tile, "left_semi"), "dealt")
        return (
            dealt.join(profiles.select("node", F.col("sign").alias("bits")), "node")
            .repartition(*tile)
            .sortWithinPartitions(*tile, "n", "node")
            .select(*tile, "node", "n", "place", "component", "home", "block", "bits")
            .mapInArrow(lambda x: _tiles_in_turn(x, percent), "a long, b long, bound int")
            .distinct()
        )

    def best(self, pairs: DataFrame, partners: int) -> DataFrame:
        order = Window.partitionBy("b").orderBy(F.desc("bound"), "a")
        return pairs.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= partners).drop("_r")

    def apart(self, pairs: DataFrame, labels: DataFrame) -> DataFrame:
        """Pairs of different components, as they are now."""
        of = lambda c: labels.select(F.col("node").alias(c), F.col("component").alias(f"_{c}"))
        return (
            pairs.join(of("a"), "a", "left")
            .join(of("b"), "b", "left")
            .where(F.coalesce("_a", "a") != F.coalesce("_b", "b"))
            .select(*pairs.columns)
        )

    def links(self, classes: DataFrame, profiles: DataFrame) -> DataFrame:
        """(node, component) of the classes that link with another."""
        write = self.scratch.write
        tiles = self.tiles(profiles)
        labels = profiles.select("node", F.col("node").alias("component")).where("false")
        tested = profiles.select(F.col("node").alias("a"), F.col("node").alias("b")).where("false")
        for turn in range(TURNS):
            found = write(self.screened(self.near_pairs(tiles, labels, turn), profiles), "near")
            # Each class tests its best pairs, whichever side of them it is.
            sides = found.select("a", "b", "bound", F.explode(F.array("a", "b")).alias("side"))
            order = Window.partitionBy("side").orderBy(F.desc("bound"), "a", "b")
            best = sides.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= TESTED)
            chosen = write(best.select("a", "b").distinct(), "chosen")
            if chosen.isEmpty():
                break
            labels = grown(labels, self.verified(chosen, classes), self.scratch)
            tested = tested.union(chosen)
        crossing = write(self.cross_pairs(tiles, profiles, labels), "crossing")
        untested = crossing.join(tested, ["a", "b"], "left_anti").select("a", "b")
        pairs = write(self.bound(untested, profiles, "bits"), "untested")
        partners = FIRST_PARTNERS
        while not pairs.isEmpty():
            chosen = write(self.best(pairs, partners), "chosen")
            labels = grown(labels, self.verified(chosen, classes), self.scratch)
            rest = pairs.join(chosen, ["a", "b"], "left_anti")
            pairs = write(self.apart(rest, labels), "untested")
            partners *= 4
        return labels


def similar(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    width: int = SHINGLE,
    percent: int = PERCENT,
    out: str = "similar",
) -> DataFrame:
    """The rows with a struct: n_shingles; component, the smallest key of the row's component; and
    group, a number that all rows of a component have, null for an empty set.

    A set is the distinct shingles of `width` words, lower case for A-Z; fewer words make one
    shingle. Two rows link when their sets have a Jaccard similarity of `percent` percent or more.
    Null, empty and white texts have an empty set, link with nothing, and name themselves.

    Rows that share a key each have the set of their own text; rows that agree in key and text are
    equal in all. Null keys link like others and name a component only if it has no other key.
    Empty tables give empty results. A column called `out` is replaced; others pass through.

    Hashes of 64 bits stand for shingles, and digests of 128 bits for sets and rows.
    """
    spark = docs.sparkSession
    use_package(spark)
    keyed = docs.select(
        row_key(named(key), named(text)).alias("row"), named(text).cast("string").alias("text")
    )
    join = _Join(spark, keyed, width, percent)
    members, frequent = join.survey()
    classes = join.classes(members)
    made = join.of_class(
        classes,
        lambda b: _profile(b, width, percent, frequent),
        "node long, n int, bits binary, sign binary, prefix array<long>",
    )
    profiles = join.scratch.write(made, "profiles")
    labels = join.links(classes, profiles)
    labelled = classes.join(labels, "node", "left").select(
        "key", F.coalesce("component", "node").alias("component")
    )
    sized = members.select("row", "n", "key").distinct()
    own = [c for c in docs.columns if c.lower() != out.lower()]
    row, side = fresh(docs, "_row", "_side")
    found = join.scratch.write(
        sized.join(small(labelled, ["key"]), "key", "left").select("row", "n", "component"), "found"
    )
    rows = docs.select(*map(named, own), row_key(named(key), named(text)).alias(row))
    found = small(packed(found, side), [side])
    marked = rows.join(found, named(row) == named(side)["row"], "left")
    component = named(side)["component"]
    first = (
        marked.where(component.isNotNull())
        .groupBy(component.alias("component"))
        .agg(F.min(named(key)).alias("first"))
    )
    names = small(packed(join.scratch.write(first, "first"), "_first"), ["_first"])
    return marked.join(names, component == F.col("_first.component"), "left").select(
        *map(named, own),
        F.struct(
            named(side)["n"].cast("long").alias("n_shingles"),
            F.coalesce(F.col("_first.first"), named(key)).alias("component"),
            component.alias("group"),
        ).alias(out),
    )


def first_of_each(
    found: DataFrame, key: str = "doc_id", text: str = "text", out: str = "similar"
) -> DataFrame:
    """One row of each component, without the struct: the one that its smallest key names.

    Rows that share this key are told apart by their text; of equal rows one stays. Rows with an
    empty set are components of their own and all stay.
    """
    s = named(out)
    rest = [c for c in found.columns if c != out]
    lone = found.where(s["n_shingles"] == 0)
    named_row = found.where((s["n_shingles"] > 0) & named(key).eqNullSafe(s["component"]))
    (order,) = fresh(found, "_order")
    # Few rows share a key, so a window holds few; the component keeps other groups apart.
    window = Window.partitionBy(named(key), s["component"], s["group"]).orderBy(named(text))
    kept = named_row.withColumn(order, F.row_number().over(window)).where(named(order) == 1)
    return kept.drop(order).unionByName(lone).select(*map(named, rest))
