"""Token ids in patched frame-of-reference blocks.

A segment is a run of whole documents. Its ids are cut into blocks of 256; a block keeps its
minimum, the differences to it packed at the width that 90 percent of them need, and the rest as
exceptions. Block starts are indexed, so a block can be read by itself. Segments are rows of a
Parquet table: Spark's commit makes a lost task harmless, and any store that Spark reads will do.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Callable, Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from syncloom.llm.common import named, packed, running_offsets, use_package

BLOCK = 256
PERCENTILE = 90
#: A segment ends with the document that brings it to so many ids.
SEGMENT_IDS = 1 << 17
MAGIC = b"PFB1"
#: Pieces of text whose ids a worker remembers, and as many from before, of which those that come up
#: again are taken over.
REMEMBERED = 600_000
#: New pieces in one text for the tokenizer.
JOINED = 1000


# --- the file format ---------------------------------------------------------------------------


def bit_lengths(values: np.ndarray) -> np.ndarray:
    """Bits that each number needs; exact, as doubles hold 32 bits."""
    return np.frexp(values.astype(np.float64))[1].astype(np.uint8)


def encode_segment(ids: np.ndarray) -> bytes:
    """Header, per block: minimum, width, starts of its packed bits and exceptions; then those.

    Differences are packed bit by bit, the lowest first, one after the other. A last block is filled up
    with its minimum. Ids are unsigned, of 32 bits at most.
    """
    ids = np.asarray(ids, dtype=np.uint32)
    n, blocks = len(ids), -(-len(ids) // BLOCK)
    full = np.empty(blocks * BLOCK, dtype=np.uint32)
    full[:n] = ids
    if n % BLOCK:
        full[n:] = ids[(blocks - 1) * BLOCK :].min()
    grid = full.reshape(blocks, BLOCK)
    lows = grid.min(axis=1) if blocks else np.empty(0, np.uint32)
    grid = grid - lows[:, None]
    at = BLOCK * PERCENTILE // 100
    widths = bit_lengths(np.partition(grid, at, axis=1)[:, at]) if blocks else np.empty(0, np.uint8)
    packed_starts = np.concatenate([[0], np.cumsum(widths.astype(np.int64) * (BLOCK // 8))])
    out = np.zeros(int(packed_starts[-1]), dtype=np.uint8)
    high = grid >> np.minimum(widths, 31)[:, None].astype(np.uint32)
    high[widths == 32] = 0
    for width in np.unique(widths):
        chosen = np.flatnonzero(widths == width)
        if not width:
            continue
        # The bits of each difference, the lowest ones first, one difference after the other.
        wide = "<u2" if width <= 16 else "<u4"
        part = (grid[chosen] & np.uint32((1 << int(width)) - 1)).astype(wide).view(np.uint8)
        bits = np.unpackbits(part.reshape(len(chosen), BLOCK, -1), axis=2, bitorder="little")
        packed = np.packbits(bits[:, :, : int(width)].reshape(len(chosen), -1), axis=1, bitorder="little")
        out[packed_starts[chosen][:, None] + np.arange(packed.shape[1])] = packed
    rows, columns = np.nonzero(high)
    exception_starts = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=blocks))])
    return b"".join(
        [
            MAGIC,
            np.array([n, blocks], dtype="<u4").tobytes(),
            lows.astype("<u4").tobytes(),
            widths.tobytes(),
            packed_starts.astype("<u4").tobytes(),
            exception_starts.astype("<u4").tobytes(),
            out.tobytes(),
            columns.astype(np.uint8).tobytes(),
            high[rows, columns].astype("<u4").tobytes(),
        ]
    )


class Segment:
    """A segment's bytes, read as a whole or by block."""

    def __init__(self, body: bytes):
        if body[:4] != MAGIC:
            raise ValueError("not a segment of token blocks")
        self.n, self.blocks = (int(x) for x in np.frombuffer(body, "<u4", 2, 4))
        self.at, self.body = 12, body
        self.lows = self._take("<u4", self.blocks)
        self.widths = self._take(np.uint8, self.blocks)
        self.packed_starts = self._take("<u4", self.blocks + 1).astype(np.int64)
        self.exception_starts = self._take("<u4", self.blocks + 1).astype(np.int64)
        # A few bytes more, so that the last difference may be read like others.
        self.packed = np.concatenate([self._take(np.uint8, int(self.packed_starts[-1])), np.zeros(8, np.uint8)])
        self.places = self._take(np.uint8, int(self.exception_starts[-1]))
        self.high = self._take("<u4", int(self.exception_starts[-1]))

    def _take(self, kind, count: int) -> np.ndarray:
        found = np.frombuffer(self.body, kind, count, self.at)
        self.at += found.nbytes
        return found

    def read(self, blocks: np.ndarray | None = None) -> np.ndarray:
        """The ids of the blocks, in order; all of them unless some are named."""
        wanted = np.arange(self.blocks) if blocks is None else np.asarray(blocks)
        grid = np.zeros((len(wanted), BLOCK), dtype=np.uint32)
        widths = self.widths[wanted]
        for width in np.unique(widths):
            if not width:
                continue
            chosen, size = np.flatnonzero(widths == width), int(width)
            bits = np.arange(BLOCK) * size
            # A difference lies in so many bytes from its first one on; what is beyond the block is cut off.
            count = -(-(7 + size) // 8)
            first, shift = bits >> 3, bits & 7
            raw = self.packed[self.packed_starts[wanted[chosen]][:, None] + np.arange(size * (BLOCK // 8) + count)]
            kind = np.uint32 if count <= 4 else np.uint64
            part = raw[:, first].astype(kind)
            for k in range(1, count):
                part |= raw[:, first + k].astype(kind) << kind(8 * k)
            part >>= shift.astype(kind)
            grid[chosen] = part & kind((1 << size) - 1)
        firsts, ends = self.exception_starts[wanted], self.exception_starts[wanted + 1]
        held = ends - firsts
        rows = np.repeat(np.arange(len(wanted)), held)
        spots = np.arange(len(rows)) + np.repeat(firsts - (np.cumsum(held) - held), held)
        grid[rows, self.places[spots]] |= self.high[spots] << widths[rows].astype(np.uint32)
        grid += self.lows[wanted][:, None]
        ids = grid.reshape(-1)
        return ids[: self.n] if blocks is None else ids


# --- tokens ------------------------------------------------------------------------------------

_CUT = re.compile(r"(?<=\S)(?= )")
_FEEDS = re.compile(r"(\n+)")
#: Letters of two ranges that are all letters to every library, then ASCII marks but the apostrophe.
_WORD, _MARKS = "[A-Za-zÀ-ÖØ-öø-ɏ]+", r"[!-&(-/:-@\[-`{-~]+"
_WORD_AND_MARKS = re.compile(f"({_WORD})({_MARKS})")
_WORD_OR_MARKS = re.compile(f"{_WORD}|{_MARKS}")
#: The same for Arrow; words or marks alone; a plain piece, without white space and control characters
#: but for the space before; two of them with line feeds between.
_APART = rf"\A(?P<word>{_WORD})(?P<marks>{_MARKS})\z"
_ALONE = rf"\A ?(?:{_WORD}|{_MARKS})\z"
_PLAIN = r"\A ?[^\p{Z}\p{C}]+\z"
_LINES = r"\A(?P<end>[^\p{Z}\p{C}]+)(?P<feeds>\n+)(?P<head>[^\p{Z}\p{C}]+)\z"


class _Slots(dict):
    """Numbers pieces of text as they come up."""

    def __init__(self, encoder: PieceEncoder, before: str, older: dict[str, int]):
        self.encoder, self.before, self.older = encoder, before, older

    def __missing__(self, piece: str) -> int:
        slot = self.encoder.add(self.before, piece, self.older.get(piece))
        if "\n" not in piece:  # two words and the end of a line seldom come again
            self[piece] = slot
        return slot


class _Grown:
    """An array that others are added to; it doubles when it is full."""

    def __init__(self, first: list, kind):
        self.held = np.array(first, dtype=kind)
        self.size = len(first)

    def add(self, values: np.ndarray) -> None:
        size = self.size + len(values)
        if size > len(self.held):
            self.held = np.resize(self.held, max(size, 2 * len(self.held)))
        self.held[self.size : size] = values
        self.size = size


def _runs(flat: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """What lies in the runs, one run after the other."""
    ends = np.cumsum(sizes)
    return flat[np.repeat(begins - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)]


def cuts_known(path: str) -> bool:
    """Whether the vocabulary's own cuts are those of byte-level BPE: letters, digits, marks and
    white space apart, a space with what follows it."""
    with open(path, encoding="utf-8") as file:
        described = json.load(file)
    first = described.get("pre_tokenizer") or {}
    return (
        first.get("type") == "ByteLevel"
        and first.get("use_regex", True)
        and not first.get("add_prefix_space")
        and described.get("normalizer") is None
    )


class PieceEncoder:
    """Encodes texts piece by piece and remembers the ids of pieces.

    Byte-level BPE never joins what lies on both sides of a space that follows another character
    than white space, so texts are cut there and the ids of the pieces put together again. A cut
    at any space is tried first; where a piece turns out to end in white space, the text is cut
    again by the rule.

    Where the vocabulary cuts as byte-level BPE mostly does, line feeds between other characters
    stand by themselves, the last of a run apart from those before, and marks at the end of a word
    apart from its letters. So a new piece with either is put together from smaller ones. New pieces
    without white space are handed to the tokenizer as lines of one text, whose line feeds say where
    the ids of each end. Lines of letters or of marks alone need no cutting: their bytes are spelled
    as byte-level BPE does, and the same model takes them line by line.

    Texts are cut, and their distinct pieces found, by Arrow; Python sees each piece of a batch once.
    """

    def __init__(self, path: str, end_id: int):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer, self.end_id = Tokenizer.from_file(path), end_id
        self.cuts_known = cuts_known(path)
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.added = [t.content for t in added]
        feed = self.tokenizer.encode("\n", add_special_tokens=False).ids
        # An added token that takes in white space could take in the line feeds; one of letters or of
        # marks alone is unknown where lines of these are encoded.
        taken = any(
            t.lstrip or t.rstrip or any(map(str.isspace, t.content)) or _WORD_OR_MARKS.fullmatch(t.content)
            for t in added
        )
        self.feed = feed[0] if self.cuts_known and len(feed) == 1 and not taken else None
        bytewise = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        letters = "\n" + "".join(map(chr, chain(range(0x20, 0x7F), range(0xC0, 0x250))))
        self.spelled = {ord(c): bytewise.pre_tokenize_str(c)[0][0] for c in letters}
        self.line_tokenizer = Tokenizer(self.tokenizer.model)
        self.line_tokenizer.pre_tokenizer = pre_tokenizers.Split(self.spelled[ord("\n")], "isolated")
        self.heads, self.rest = _Slots(self, "", {}), _Slots(self, " ", {})
        self.begins = self.sizes = self.flat = _Grown([], np.int64)
        self.clear()

    def clear(self) -> None:
        """Start anew, with what is known so far as the older generation."""
        self.heads.older, self.rest.older = {}, {}  # before that there is nothing to remember
        self.heads, self.rest = _Slots(self, "", self.heads), _Slots(self, " ", self.rest)
        self.older = tuple(a.held[: a.size].copy() for a in (self.begins, self.sizes, self.flat))
        self.feeds: dict[tuple[int, bool], int] = {}
        self.waiting: list[str | tuple[int, ...] | list[int]] = []
        self.count = 1  # the first slot is the end id
        self.odd: list[int] = []  # of the pieces that wait
        self.odd_flags = _Grown([False], bool)
        self.begins, self.sizes = _Grown([0], np.int64), _Grown([1], np.int64)
        self.flat = _Grown([self.end_id], np.uint32)

    def _slot(self, entry: str | tuple[int, ...] | list[int]) -> int:
        """A new slot for a text to encode, for slots to be put together, or for known ids."""
        self.waiting.append(entry)
        self.count += 1
        return self.count - 1

    def add(self, before: str, piece: str, older: int | None) -> int:
        if older is not None:
            begins, sizes, flat = self.older
            slot = self._slot(flat[begins[older] : begins[older] + sizes[older]].tolist())
        elif self.cuts_known and (cut := self._cut(before, piece)):
            slot = self._slot(cut)
        else:
            slot = self._slot(before + piece)
        if piece[-1:].isspace() or (not piece and before):
            self.odd.append(slot)
        return slot

    def _cut(self, before: str, piece: str) -> tuple[int, ...] | None:
        """The slots of smaller pieces that a piece is made of, if it can be cut."""
        first = self.rest if before else self.heads
        if found := _WORD_AND_MARKS.fullmatch(piece):
            word, marks = found.groups()
            return first[word], self.heads[marks]
        if "\n" not in piece:
            return None
        parts = _FEEDS.split(piece)  # what stands between runs of line feeds, and these
        words = parts[::2]
        if not words[0] and before or any(w and (w[0].isspace() or w[-1].isspace()) for w in words):
            return None
        slots = [first[words[0]]] if words[0] else []
        for feeds, word in zip(parts[1::2], words[1:], strict=True):
            slots.append(self._feeds(len(feeds), not word))
            if word:
                slots.append(self.heads[word])
        return tuple(slots)

    def _feeds(self, n: int, last: bool) -> int:
        """The slot of n line feeds, at the end of the text or before another character."""
        if (n, last) not in self.feeds:
            apart = n > 1 and not last
            entry = (self._feeds(n - 1, True), self._feeds(1, True)) if apart else "\n" * n
            self.feeds[n, last] = self._slot(entry)
        return self.feeds[n, last]

    def _learn(self) -> None:
        """Ids of the pieces that wait; what is put together comes after its pieces."""
        if not self.waiting:
            return
        entries, self.waiting = self.waiting, []
        first = self.count - len(entries)
        whole = iter(self._encode([e for e in entries if isinstance(e, str)]))
        parts: list[list[int]] = []
        begins, sizes, flat = self.begins.held, self.sizes.held, self.flat.held
        for entry in entries:
            if isinstance(entry, str):
                parts.append(next(whole))
                continue
            if isinstance(entry, list):
                parts.append(entry)
                continue
            joined: list[int] = []
            for slot in entry:
                if slot >= first:
                    joined += parts[slot - first]
                else:
                    joined += flat[begins[slot] : begins[slot] + sizes[slot]].tolist()
            parts.append(joined)
        odd = np.zeros(len(parts), dtype=bool)
        odd[np.array(self.odd, dtype=np.int64) - first] = True
        self.odd, self.count = [], first
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        self._grow(np.fromiter(chain.from_iterable(parts), np.uint32, int(sizes.sum())), sizes, odd)

    def _grow(self, ids: np.ndarray, sizes: np.ndarray, odd: np.ndarray | None = None) -> range:
        """Slots for pieces whose ids are known; no others wait."""
        self.begins.add(self.flat.size + np.cumsum(sizes) - sizes)
        self.sizes.add(sizes)
        self.odd_flags.add(np.zeros(len(sizes), dtype=bool) if odd is None else odd)
        self.flat.add(ids)
        first, self.count = self.count, self.count + len(sizes)
        return range(first, self.count)

    def _encode(self, texts: list[str]) -> list[list[int]]:
        """The ids of each text, those of plain pieces in few calls."""
        found: list[list[int]] = [[]] * len(texts)
        if self.feed is None or not texts:
            plain = np.zeros(len(texts), dtype=bool)
        else:
            plain = pc.match_substring_regex(pa.array(texts, pa.string()), _PLAIN).to_numpy(zero_copy_only=False)
        others = np.flatnonzero(~plain).tolist()
        whole = self.tokenizer.encode_batch_fast([texts[i] for i in others], add_special_tokens=False)
        for i, one in zip(others, whole, strict=True):
            found[i] = one.ids
        lines = np.flatnonzero(plain).tolist()
        ids, sizes = self._encode_lines([texts[i] for i in lines])
        ends, ids = np.cumsum(sizes).tolist(), ids.tolist()
        for i, begin, end in zip(lines, [0, *ends], ends):
            found[i] = ids[begin:end]
        return found

    def _encode_lines(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of plain pieces, and the number of ids of each."""
        alone = pc.match_substring_regex(pa.array(pieces, pa.string()), _ALONE).to_numpy(zero_copy_only=False)
        order = np.concatenate([np.flatnonzero(alone), np.flatnonzero(~alone)])
        first = int(alone.sum())
        ids, sizes = [np.empty(0, np.uint32)], [np.empty(0, np.int64)]
        for chosen, tokenizer in ((order[:first], self.line_tokenizer), (order[first:], self.tokenizer)):
            lines = [pieces[i] for i in chosen.tolist()]
            texts = ["\n".join([*lines[i : i + JOINED], ""]) for i in range(0, len(lines), JOINED)]
            if tokenizer is self.line_tokenizer:
                texts = [t.translate(self.spelled) for t in texts]
            found = tokenizer.encode_batch_fast(texts, add_special_tokens=False)
            with_feeds = np.concatenate([ids[0], *(np.array(f.ids, dtype=np.uint32) for f in found)])
            feeds = np.flatnonzero(with_feeds == self.feed)
            if len(feeds) != len(lines):
                raise ValueError("the tokenizer joined line feeds with what stands beside them")
            ids.append(np.delete(with_feeds, feeds))
            sizes.append(np.diff(feeds, prepend=-1) - 1)
        flat, counts = np.concatenate(ids), np.concatenate(sizes)
        begins, back = np.cumsum(counts) - counts, np.argsort(order)
        return _runs(flat, begins[back], counts[back]), counts[back]

    def _add_plain(self, table: _Slots, pieces: list[str]) -> None:
        """Slots for new plain pieces: ids of the older generation, or of the tokenizer."""
        older = np.fromiter(map(table.older.get, pieces, repeat(-1)), np.int64, len(pieces))
        held, new = np.flatnonzero(older >= 0), np.flatnonzero(older < 0)
        begins, sizes, flat = self.older
        begins, sizes = begins[older[held]], sizes[older[held]]
        found = [pieces[i] for i in held.tolist()]
        table.update(zip(found, self._grow(_runs(flat, begins, sizes), sizes), strict=True))
        found = [pieces[i] for i in new.tolist()]
        lines = [table.before + p for p in found] if table.before else found
        table.update(zip(found, self._grow(*self._encode_lines(lines)), strict=True))

    def _put_together(self, parts: np.ndarray) -> range:
        """New slots, each for the pieces whose slots stand in its row."""
        sizes = self.sizes.held[parts]
        ids = _runs(self.flat.held, self.begins.held[parts.ravel()], sizes.ravel())
        return self._grow(ids, sizes.sum(axis=1))

    def _slots_of(self, table: _Slots, pieces: pa.Array) -> np.ndarray:
        """The slots of pieces that follow a space, or that none comes before, as the table says."""
        coded = pieces.dictionary_encode()
        texts = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        slots = np.fromiter(map(table.get, texts, repeat(-1)), np.int64, len(texts))
        new = np.flatnonzero(slots < 0)
        if self.feed is not None and len(new):
            self._learn()
            slots[new] = self._new_slots(table, coded.dictionary.take(pa.array(new)), [texts[i] for i in new.tolist()])
            new = np.flatnonzero(slots < 0)
        slots[new] = np.fromiter(map(table.__getitem__, [texts[i] for i in new.tolist()]), np.int64, len(new))
        return slots[coded.indices.to_numpy()]

    def _new_slots(self, table: _Slots, pieces: pa.Array, texts: list[str]) -> np.ndarray:
        """Slots for distinct new pieces; -1 for those with other white space than single line ends."""
        slots = np.full(len(texts), -1, dtype=np.int64)
        is_plain = pc.match_substring_regex(pieces, _PLAIN)
        words, lines = pc.extract_regex(pieces, _APART), pc.extract_regex(pieces, _LINES)
        plain, apart, broken = (
            np.flatnonzero(m.to_numpy(zero_copy_only=False))
            for m in (pc.and_not(is_plain, words.is_valid()), words.is_valid(), lines.is_valid())
        )
        found = [texts[i] for i in plain.tolist()]
        self._add_plain(table, found)
        slots[plain] = np.fromiter(map(table.__getitem__, found), np.int64, len(found))
        if len(apart):
            words = words.take(pa.array(apart))
            first = self._slots_of(table, pc.struct_field(words, "word"))
            marks = self._slots_of(self.heads, pc.struct_field(words, "marks"))
            slots[apart] = self._put_together(np.column_stack([first, marks]))
            table.update(zip([texts[i] for i in apart.tolist()], slots[apart].tolist(), strict=True))
        if len(broken):  # two words and the end of a line seldom come again
            lines = lines.take(pa.array(broken))
            end = self._slots_of(table, pc.struct_field(lines, "end"))
            head = self._slots_of(self.heads, pc.struct_field(lines, "head"))
            runs = pc.utf8_length(pc.struct_field(lines, "feeds")).to_numpy()
            feeds = {n: self._feeds(n, False) for n in np.unique(runs).tolist()}
            self._learn()
            between = np.fromiter(map(feeds.__getitem__, runs.tolist()), np.int64, len(runs))
            slots[broken] = self._put_together(np.column_stack([end, between, head]))
        return slots

    def _by_the_rule(self, text: str) -> np.ndarray:
        if any(map(text.__contains__, self.added)):
            # What the vocabulary takes as a whole is cut out before all else.
            return np.array([self._slot(text), 0])
        first, *others = _CUT.split(text)
        return np.array([self.heads[first], *(self.rest[o[1:]] for o in others), 0])

    def encode(self, texts: pa.Array | list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, the end id after each text, and the number of ids of each text."""
        column = pc.fill_null(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()), "")
        rows = len(column)
        if not rows:
            return np.empty(0, np.uint32), np.empty(0, np.int64)
        if len(self.heads) + len(self.rest) > REMEMBERED:
            self.clear()
        cut = pc.split_pattern(column, " ")
        offsets, pieces = cut.offsets.to_numpy().astype(np.int64), cut.values
        # A place for each piece of a text, and one for the end id.
        bounds = offsets + np.arange(rows + 1)
        chosen = np.zeros(bounds[-1], dtype=np.int64)
        is_rest = np.ones(len(pieces), dtype=bool)
        is_rest[offsets[:-1]] = False
        chosen[bounds[:-1]] = self._slots_of(self.heads, pieces.take(pa.array(offsets[:-1])))
        places = np.arange(len(pieces)) + np.repeat(np.arange(rows), np.diff(offsets))
        chosen[places[is_rest]] = self._slots_of(self.rest, pieces.filter(pa.array(is_rest)))
        self._learn()
        # A piece that ends in white space is fine at the end of its text only.
        inner = np.flatnonzero(self.odd_flags.held[chosen[:-1]] & (chosen[1:] != 0))
        again = set((np.searchsorted(bounds, inner, side="right") - 1).tolist())
        for whole in self.added:
            again.update(np.flatnonzero(pc.match_substring(column, whole).to_numpy(zero_copy_only=False)).tolist())
        if again:
            parts = np.split(chosen, bounds[1:-1])
            for k in again:
                parts[k] = self._by_the_rule(column[k].as_py())
            self._learn()
            chosen = np.concatenate(parts)
            bounds = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        sizes = self.sizes.held[chosen]
        ends = np.cumsum(sizes)
        return _runs(self.flat.held, self.begins.held[chosen], sizes), np.diff(ends[bounds[1:] - 1], prepend=0)


_encoders: dict[tuple[str, int], PieceEncoder] = {}


def _encoder(path: str | Callable[[], str], end_id: int) -> PieceEncoder:
    """One for each worker process, so that it remembers from task to task."""
    path = path if isinstance(path, str) else path()
    if (path, end_id) not in _encoders:
        _encoders[path, end_id] = PieceEncoder(path, end_id)
    return _encoders[path, end_id]


# --- writing and reading with Spark ------------------------------------------------------------


def _write_segments(
    batches: Iterator[pa.RecordBatch], path: str | Callable[[], str], end_id: int, segment_ids: int, key_type: pa.DataType
) -> Iterator[pa.RecordBatch]:
    encoder, part = _encoder(path, end_id), TaskContext.get().partitionId()
    number, written = 0, 0
    keys: list = []
    lengths: list[np.ndarray] = []
    ids: list[np.ndarray] = []

    def segment():
        nonlocal number, written, keys, lengths, ids
        body = np.concatenate(ids)
        row = pa.RecordBatch.from_pydict(
            {
                "part": pa.array([part], pa.int32()),
                "segment": pa.array([number], pa.int32()),
                "before": pa.array([written], pa.int64()),
                "n_ids": pa.array([len(body)], pa.int64()),
                "keys": pa.array([keys], pa.list_(key_type)),
                "lengths": pa.array([np.concatenate(lengths).astype(np.int64)], pa.list_(pa.int64())),
                "body": pa.array([encode_segment(body)], pa.binary()),
            }
        )
        number, written = number + 1, written + len(body)
        keys, lengths, ids = [], [], []
        return row

    for batch in batches:
        for start in range(0, batch.num_rows, 512):
            rows = batch.slice(start, 512)
            found, counts = encoder.encode(rows.column("text"))
            keys += rows.column("key").to_pylist()
            lengths.append(counts)
            ids.append(found)
            if sum(map(len, ids)) >= segment_ids:
                yield segment()
    if keys:
        yield segment()


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer: str | Callable[[], str],
    end_id: int,
    key: str = "doc_id",
    text: str = "text",
    segment_ids: int = SEGMENT_IDS,
) -> None:
    """Write the ids of all texts to a table of segments at `path`, in ascending order of the key.

    `tokenizer` is the path of a vocabulary file, or a function that gives it where it is called,
    which is on the workers.

    Rows are dealt into ranges of the key (and text, for equal keys), so parts follow each other.
    Null and empty texts have the end id alone; null keys come first, repeated rows stay. An empty
    table gives a table without segments. Other columns are not read.
    """
    use_package(docs.sparkSession)
    rows = docs.select(named(key).alias("key"), named(text).alias("text"))
    key_type = rows.schema["key"].dataType
    schema = T.StructType(
        [
            T.StructField("part", T.IntegerType()),
            T.StructField("segment", T.IntegerType()),
            T.StructField("before", T.LongType()),
            T.StructField("n_ids", T.LongType()),
            T.StructField("keys", T.ArrayType(key_type)),
            T.StructField("lengths", T.ArrayType(T.LongType())),
            T.StructField("body", T.BinaryType()),
        ]
    )
    from pyspark.sql.pandas.types import to_arrow_type

    arrow_key = to_arrow_type(key_type)
    order = ["key", F.xxhash64("text"), "text"]
    ordered = rows.repartitionByRange(*order[:2]).sortWithinPartitions(*order)
    ordered.mapInArrow(
        lambda b: _write_segments(b, tokenizer, end_id, segment_ids, arrow_key), schema
    ).write.parquet(path)


def _read_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            ids = Segment(batch.column("body")[i].as_py()).read()
            lengths = batch.column("lengths")[i].values.to_numpy()
            ends = np.cumsum(lengths)
            base = batch.column("start")[i].as_py() + batch.column("before")[i].as_py()
            raw = ids.astype("<u4")
            crcs = [zlib.crc32(raw[e - n : e]) for e, n in zip(ends, lengths, strict=True)]
            yield pa.RecordBatch.from_pydict(
                {
                    "key": batch.column("keys")[i].values,
                    "start": pa.array(base + ends - lengths, pa.int64()),
                    "n_tokens": pa.array(lengths, pa.int64()),
                    "ids_crc32": pa.array(crcs, pa.int64()),
                    "body_bytes": pa.array([len(batch.column("body")[i].as_py())] + [0] * (len(crcs) - 1), pa.int64()),
                }
            )


def read_documents(spark: SparkSession, path: str, key: str = "doc_id") -> DataFrame:
    """Per document of the segments: key, start, n_tokens, ids_crc32, from the decoded ids.

    `start` counts the ids of all documents before it: those of the parts before, by a running sum
    over one row for each part, and those before it in its part. `body_bytes` is the size of the
    segment, at its first document.
    """
    use_package(spark)
    segments = spark.read.parquet(path)
    parts = segments.groupBy("part").agg(F.sum("n_ids").alias("_n"))
    starts = running_offsets(parts, [], "part", "_n", "start").select("part", "start")
    rows = segments.join(packed(starts, "_s"), F.col("part") == F.col("_s.part")).select(
        F.col("_s.start").alias("start"), "before", "keys", "lengths", "body"
    )
    key_type = segments.schema["keys"].dataType.elementType
    schema = T.StructType(
        [
            T.StructField("key", key_type),
            *[T.StructField(c, T.LongType()) for c in ("start", "n_tokens", "ids_crc32", "body_bytes")],
        ]
    )
    return rows.mapInArrow(_read_segments, schema).withColumnRenamed("key", key)


def _ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            ids = Segment(batch.column("body")[i].as_py()).read()
            lengths = batch.column("lengths")[i].values.to_numpy()
            offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.astype(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("keys")[i].values, lists], ["key", "ids"])


def read_ids(spark: SparkSession, path: str, key: str = "doc_id") -> DataFrame:
    """(key, ids): the documents' ids, the end id last."""
    use_package(spark)
    segments = spark.read.parquet(path).select("keys", "lengths", "body")
    key_type = segments.schema["keys"].dataType.elementType
    schema = T.StructType(
        [T.StructField("key", key_type), T.StructField("ids", T.ArrayType(T.LongType()))]
    )
    return segments.mapInArrow(_ids, schema).withColumnRenamed("key", key)
