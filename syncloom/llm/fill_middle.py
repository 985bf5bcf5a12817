"""Fill-in-middle examples, cut at unit boundaries that a wavelet matrix counts.

The code points of a batch of texts become classes of eight: white or not, line feed or word
character or other, and whether the character ends its run of white or other characters. A wavelet
matrix over them answers how many characters of a class a span holds. The number of units that a
prefix closes is a sum of such ranks, one for each class that closes a unit; the place after the
k-th unit is found by bisection on that sum, for all texts of the batch at once.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from syncloom.llm.common import named, use_package

#: Bits of a class.
WHITE, KIND, LAST = 4, 2, 1
BITS = 3
#: The classes whose characters close a unit: the last of a run of other characters, or a line feed.
CLOSING = {"words": (LAST, KIND | LAST), "lines": (WHITE | KIND, WHITE | KIND | LAST)}
MARKS = ("<P>", "<S>", "<M>")
PLAIN, PSM, SPM = "plain", "psm", "spm"
#: Code points whose matrix is held at a time; a longer text is a batch of its own.
POINTS = 1 << 22

_TABLE = np.full(129, KIND, dtype=np.uint8)  # beyond ASCII: word characters
_TABLE[:128] = 0
_TABLE[[*range(48, 58), *range(65, 91), *range(97, 123)]] = KIND
_TABLE[[9, 11, 12, 13, 32]] = WHITE
_TABLE[10] = WHITE | KIND


def code_points(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """The code points of all texts, and where each text begins; the end comes last."""
    ends = np.cumsum([0, *map(len, texts)])
    raw = "".join(texts).encode("utf-32-le", "surrogatepass")
    return np.frombuffer(raw, dtype="<u4"), ends


def classes(points: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The class of each code point; a run ends with its text at the latest."""
    found = _TABLE[np.minimum(points, 128)]
    if len(found):
        white = found & WHITE
        last = np.ones(len(found), dtype=bool)
        np.not_equal(white[1:], white[:-1], out=last[:-1])
        ends = bounds[1:]
        last[ends[ends > 0] - 1] = True
        found = found | last.astype(np.uint8) * np.uint8(LAST)
    return found


class WaveletMatrix:
    """Ranks of small numbers in a sequence: one bit vector for each bit, the highest first.

    Each level keeps the bits as 64-bit words with the ones before each word, and sorts the
    sequence by the bit, zeros first and in order.
    """

    def __init__(self, symbols: np.ndarray, bits: int = BITS):
        self.bits, self.levels = bits, []
        for b in reversed(range(bits)):
            bit = (symbols >> np.uint8(b)) & np.uint8(1)
            padded = np.zeros(-(-(len(bit) + 1) // 64) * 64, dtype=np.uint8)
            padded[: len(bit)] = bit
            words = np.packbits(padded, bitorder="little").view(np.uint64)
            before = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])
            zeros = len(bit) - int(before[-1])
            self.levels.append((words, before, zeros))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])

    def rank(self, symbol: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """How many of the symbols in [start, end) are this one."""
        for level, (words, before, zeros) in enumerate(self.levels):
            ones = []
            for at in (start, end):
                low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
                ones.append(before[at >> 6] + np.bitwise_count(words[at >> 6] & low))
            if symbol >> (self.bits - 1 - level) & 1:
                start, end = zeros + ones[0], zeros + ones[1]
            else:
                start, end = start - ones[0], end - ones[1]
        return end - start


class Units:
    """The units of a batch of texts."""

    def __init__(self, texts: Sequence[str], unit: str = "words"):
        points, self.bounds = code_points(texts)
        symbols = classes(points, self.bounds)
        self.closing = CLOSING[unit]
        self.matrix = WaveletMatrix(symbols)
        self.start, self.end = self.bounds[:-1], self.bounds[1:]
        self.closed = self.count(self.start, self.end)
        # What follows the last boundary is a unit too.
        last = symbols[np.maximum(self.end - 1, 0)] if len(symbols) else np.zeros(len(texts), np.uint8)
        rest = (self.end > self.start) & ~np.isin(last, self.closing)
        self.n = self.closed + rest

    def count(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Units that are closed in [start, end)."""
        return sum(self.matrix.rank(c, start, end) for c in self.closing)

    def after(self, k: np.ndarray) -> np.ndarray:
        """Per text, the place in it after k of its units."""
        low, high = self.start.copy(), self.end.copy()
        inside = k <= self.closed
        low[~inside] = self.end[~inside]
        high[k <= 0] = self.start[k <= 0]
        while (open_ := low < high).any():
            middle = (low + high) // 2
            enough = self.count(self.start, middle) >= k
            high = np.where(open_ & enough, middle, high)
            low = np.where(open_ & ~enough, middle + 1, low)
        return low - self.start


def _pieces(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Runs of rows of POINTS code points at most, one row at least."""
    start = total = 0
    for i, text in enumerate(texts):
        if i > start and total + len(text) > POINTS:
            yield start, i
            start, total = i, 0
        total += len(text)
    if start < len(texts):
        yield start, len(texts)


def arrange(
    texts: list[str], draws: np.ndarray, unit: str, rate: int, spm: int, marks: Sequence[str]
) -> Iterator[tuple[int, str, int | None, int | None, str]]:
    """Per text: units, form, length of the prefix and of the middle, output."""
    p, s, m = marks
    for a, b in _pieces(texts):
        rows, h = texts[a:b], draws[a:b]
        units = Units(rows, unit)
        cuts = np.sort(h[:, :2] % (units.n + 1)[:, None], axis=1)
        first, second = units.after(cuts[:, 0]), units.after(cuts[:, 1])
        for i, text in enumerate(rows):
            if not text or h[i, 2] % 100 >= rate or any(mark in text for mark in marks):
                yield int(units.n[i]), PLAIN, None, None, text
                continue
            x, y = int(first[i]), int(second[i])
            prefix, middle, suffix = text[:x], text[x:y], text[y:]
            if h[i, 3] % 100 < spm:
                form, output = SPM, f"{s}{suffix}{p}{prefix}{m}{middle}"
            else:
                form, output = PSM, f"{p}{prefix}{s}{suffix}{m}{middle}"
            yield int(units.n[i]), form, x, y - x, output


def _transformed(unit: str, rate: int, spm: int, marks: Sequence[str]):
    """The worker's part, over Arrow arrays."""

    def run(text: pa.Array, h1: pa.Array, h2: pa.Array, h3: pa.Array, h4: pa.Array) -> pa.Array:
        draws = np.stack([h.to_numpy(zero_copy_only=False) for h in (h1, h2, h3, h4)], axis=1)
        texts = [t or "" for t in text.to_pylist()]
        rows = list(arrange(texts, draws.astype(np.int64), unit, rate, spm, marks))
        n, form, prefix, middle, output = zip(*rows, strict=True) if rows else [()] * 5
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
        columns = [pa.array(c, k) for c, k in zip((n, form, prefix, middle, output), kinds, strict=True)]
        names = ["n", "form", "prefix_chars", "middle_chars", "output"]
        return pa.StructArray.from_arrays(columns, names)

    return F.arrow_udf(
        run, "n long, form string, prefix_chars long, middle_chars long, output string"
    )


def draw(digest: Column, group: int) -> Column:
    """The group of 8 hex digits of this number, from 0, as an unsigned whole number."""
    return F.conv(F.substring(digest, 8 * group + 1, 8), 16, 10).cast("long")


def fill_in_middle(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    seed: int = 42,
    rate: int = 50,
    spm: int = 80,
    unit: str = "words",
    marks: Sequence[str] = MARKS,
    out: str = "fim",
) -> DataFrame:
    """The rows with a struct: n, form, prefix_chars, middle_chars, output.

    A text is cut into units: runs of white space with the word that follows ("words"), or lines
    with their line feed ("lines"); what is left at the end is a unit too. Two cuts drawn from the
    SHA-256 of seed and key part prefix, middle and suffix. `rate` percent of the rows are
    transformed, `spm` percent of these with the suffix first. A text that is empty or has one of
    the marks stays as it is, in plain form, as do the others.

    A null text counts as empty, a null key as the empty string. Rows that share key and text get
    the same output, so do repeated rows. Empty tables give empty results. A column called `out` is
    replaced; others pass through, and only key and text are read here.
    """
    if unit not in CLOSING:
        raise ValueError(f"unknown unit {unit}")
    use_package(docs.sparkSession)
    seeded = F.concat(F.lit(f"{seed}:"), F.coalesce(named(key).cast("string"), F.lit("")))
    digest = F.sha2(seeded, 256)
    made = _transformed(unit, rate, spm, tuple(marks))(
        named(text).cast("string"), *[draw(digest, g) for g in range(4)]
    )
    own = [c for c in docs.columns if c.lower() != out.lower()]
    return docs.select(*map(named, own), made.alias(out))


def restored(output: Column, form: Column, marks: Sequence[str] = MARKS) -> Column:
    """The text that an output was made of. Marks begin and end like no text they stand in, so the
    first place of each is its own."""
    p, s, m = marks
    at = {x: F.instr(output, x) for x in marks}
    after = lambda x: F.substr(output, at[x] + F.lit(len(x)))
    between = lambda x, y: F.substr(output, at[x] + F.lit(len(x)), at[y] - at[x] - F.lit(len(x)))
    psm = F.concat(between(p, s), after(m), between(s, m))
    spm = F.concat(between(p, m), after(m), between(s, p))
    return F.when(form == PLAIN, output).when(form == PSM, psm).otherwise(spm)
