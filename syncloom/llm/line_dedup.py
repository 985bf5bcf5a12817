"""Line dedup: hashes in ranges, sorted by document and position, become keep bitmaps."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from syncloom.llm.common import (
    Scratch,
    fresh,
    named,
    packed,
    row_key,
    small,
    use_package,
)


def _hash_lines(batches: Iterator[pa.RecordBatch], least_chars: int) -> Iterator[pa.RecordBatch]:
    """For each line whose key is long enough: its hash, its document and its position.

    Bytes strip and lower just the ASCII characters that the key rule names.
    """
    for batch in batches:
        hashes, rows, places = [], [], []
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        for row, text in enumerate(texts):
            for place, line in enumerate((text or b"").split(b"\n")):
                key = line.strip().lower()
                if len(key) < least_chars or (least_chars > 1 and len(key.decode()) < least_chars):
                    continue
                hashes.append(hashlib.md5(key).digest())
                rows.append(row)
                places.append(place)
        picks = pa.array(rows, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(hashes, pa.binary()),
                batch.column("doc_id").take(picks),
                batch.column("doc_key").take(picks),
                pa.array(places, pa.int32()),
            ],
            ["hash", "doc_id", "doc_key", "position"],
        )


def line_rows(docs: DataFrame, key: str, text: str, least_chars: int) -> DataFrame:
    """(hash, doc_id, doc_key, position): the lines whose key is long enough."""
    use_package(docs.sparkSession)
    keyed = docs.select(
        named(key).alias("doc_id"),
        row_key(named(key), named(text)).alias("doc_key"),
        named(text).cast("string").alias("text"),
    )
    schema = T.StructType(
        [
            T.StructField("hash", T.BinaryType()),
            T.StructField("doc_id", keyed.schema["doc_id"].dataType),
            T.StructField("doc_key", T.BinaryType()),
            T.StructField("position", T.IntegerType()),
        ]
    )
    return keyed.mapInArrow(lambda batches: _hash_lines(batches, least_chars), schema)


def _changes(column: pa.Array, before) -> np.ndarray:
    """Where a sorted column differs from the row above; `before` is the row above the first."""
    found = np.ones(len(column), dtype=bool)
    found[0] = column[0].as_py() != before
    if len(column) > 1:
        found[1:] = pc.not_equal(column.slice(1), column.slice(0, len(column) - 1)).to_numpy(
            zero_copy_only=False
        )
    return found


def stream_runs(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """For each run of a hash in a sorted partition: documents, and its first occurrence.

    One run is held at a time. Runs of fewer than `least` documents are left out, but for the first
    and the last of a partition, which may go on next door.
    """
    last_hash = last_doc = None
    run: list | None = None  # [hash, documents, doc_id, doc_key, position, at the edge]
    seen = False

    def table(runs, schema):
        columns = list(zip(*[r[:5] for r in runs], strict=True))
        arrays = [pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    schema = None
    for batch in batches:
        if not batch.num_rows:
            continue
        h, ids, docs, at = (batch.column(n) for n in ("hash", "doc_id", "doc_key", "position"))
        schema = schema or pa.schema(
            [
                ("hash", pa.binary()),
                ("docs", pa.int64()),
                ("doc_id", ids.type),
                ("doc_key", pa.binary()),
                ("position", pa.int32()),
            ]
        )
        new_hash = _changes(h, last_hash)
        new_doc = new_hash | _changes(docs, last_doc)
        starts = np.flatnonzero(new_hash)
        running = np.concatenate([[0], np.cumsum(new_doc)])
        bounds = np.append(starts, len(h))
        if run is not None:
            run[1] += int(running[bounds[0]])
        done = [run] if run is not None and len(starts) else []
        counts = running[bounds[1:]] - running[bounds[:-1]]
        kept = (counts >= least) if len(starts) else np.zeros(0, dtype=bool)
        if len(starts):
            kept[-1] = True  # still open
            if not seen:
                kept[0] = True
            picks = pa.array(starts[kept])
            runs = [
                list(r)
                for r in zip(
                    h.take(picks).to_pylist(),
                    counts[kept].tolist(),
                    ids.take(picks).to_pylist(),
                    docs.take(picks).to_pylist(),
                    at.take(picks).to_pylist(),
                    [False] * len(picks),
                    strict=True,
                )
            ]
            if not seen:
                runs[0][5] = True
                seen = True
            run = runs.pop()
            done += runs
        done = [r for r in done if r[1] >= least or r[5]]
        if done:
            yield table(done, schema)
        last_hash, last_doc = h[len(h) - 1].as_py(), docs[len(docs) - 1].as_py()
    if run is not None:
        yield table([run], schema)


def frequent_lines(lines: DataFrame, least_docs: int) -> DataFrame:
    """(hash, first_key, first_position) of the lines found in at least so many documents.

    Rows are dealt into ranges of (hash, document), so a line that a third of all rows have goes to
    many tasks; a run that crosses into the next range is put together from its parts.
    """
    use_package(lines.sparkSession)
    id_type = lines.schema["doc_id"].dataType
    schema = T.StructType(
        [
            T.StructField("hash", T.BinaryType()),
            T.StructField("docs", T.LongType()),
            T.StructField("doc_id", id_type),
            T.StructField("doc_key", T.BinaryType()),
            T.StructField("position", T.IntegerType()),
        ]
    )
    order = ["hash", "doc_id", "doc_key", "position"]
    ranged = (
        lines.select(*order)
        .repartitionByRange("hash", "doc_id", "doc_key")
        .sortWithinPartitions(*order)
    )
    least = min(2, least_docs)
    runs = ranged.mapInArrow(lambda batches: stream_runs(batches, least), schema)
    return (
        runs.groupBy("hash")
        .agg(
            F.sum("docs").alias("docs"),
            F.min(F.struct("doc_id", "doc_key", "position")).alias("first"),
        )
        .where(F.col("docs") >= least_docs)
        .select(
            "hash",
            F.col("first.doc_key").alias("first_key"),
            F.col("first.position").alias("first_position"),
        )
    )


@F.pandas_udf(T.BinaryType())
def pack_keep(n_lines: pd.Series, dropped: pd.Series) -> pd.Series:
    """Deflated bits, one for each line, 1 where the line stays."""

    def one(n, gone):
        keep = np.ones(n, dtype=np.uint8)
        if gone is not None and len(gone):
            keep[np.asarray(gone, dtype=np.int64)] = 0
        return zlib.compress(np.packbits(keep).tobytes(), 1)

    return pd.Series([one(n, gone) for n, gone in zip(n_lines, dropped, strict=True)])


@F.pandas_udf(T.StringType())
def apply_keep(text: pd.Series, bitmap: pd.Series) -> pd.Series:
    """The lines whose bit is set, joined again; null where either is null."""

    def one(body, bits):
        if body is None or bits is None:
            return None
        lines = body.split("\n")
        keep = np.unpackbits(np.frombuffer(zlib.decompress(bits), np.uint8), count=len(lines))
        return "\n".join([line for line, k in zip(lines, keep.tolist(), strict=True) if k])

    return pd.Series([one(b, m) for b, m in zip(text, bitmap, strict=True)], dtype=object)


def line_bitmaps(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    least_docs: int = 10,
    least_chars: int = 1,
    keep_first: bool = False,
    out: str = "lines",
) -> DataFrame:
    """The documents with a struct: n_lines, n_dropped, keep (the deflated bitmap of their lines).

    A line's key is the line without white space at its ends, A-Z in lower case. Keys of at least
    `least_chars` code points that stand in at least `least_docs` documents lose all their lines;
    with `keep_first` their first line, by document id, row and position, stays.

    Text splits at line feeds. A null or empty text is one empty line. A null id is an id; rows
    that agree in id and text count as one document and get the same bitmap; rows that share an id
    alone are documents of their own. Empty tables give empty results. A column called `out` is
    replaced; others pass through.
    """
    scratch = Scratch(docs.sparkSession, "lines")
    # Hashes and places only; the text is read again where lines go.
    lines = scratch.write(line_rows(docs, key, text, least_chars), "lines")
    gone = small(scratch.write(frequent_lines(lines, least_docs), "frequent"), ["hash"])
    hits = lines.join(gone, "hash")
    if keep_first:
        is_first = (F.col("doc_key") == F.col("first_key")) & (
            F.col("position") == F.col("first_position")
        )
        hits = hits.where(~is_first)
    per_doc = hits.groupBy("doc_key").agg(F.sort_array(F.collect_set("position")).alias("dropped"))
    own = [c for c in docs.columns if c.lower() != out.lower()]
    join_key, count, side = fresh(docs, "_key", "_n_lines", "_side")
    found = small(packed(scratch.write(per_doc, "dropped"), side), [side])
    body = F.coalesce(named(text), F.lit(""))
    sized = docs.withColumns(
        {
            join_key: row_key(named(key), named(text)),
            count: F.size(F.split(body, "\n")),
        }
    )
    joined = sized.join(found, named(join_key) == named(side)["doc_key"], "left")
    dropped = named(side)["dropped"]
    return joined.select(
        *map(named, own),
        F.struct(
            named(count).cast("long").alias("n_lines"),
            F.coalesce(F.size(dropped), F.lit(0)).cast("long").alias("n_dropped"),
            pack_keep(named(count), dropped).alias("keep"),
        ).alias(out),
    )


def kept_text(docs: DataFrame, text: str = "text", out: str = "lines") -> Column:
    """The text without its dropped lines; texts that lose none never leave the JVM."""
    changed = named(out)["n_dropped"] > 0
    body = F.coalesce(named(text), F.lit(""))
    cut = apply_keep(F.when(changed, body), F.when(changed, named(out)["keep"]))
    return F.when(changed, cut).otherwise(body)
