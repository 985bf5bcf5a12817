"""Personal data by rules and by a character-level bidirectional LSTM with a CRF, in numpy.

Rules find the plain forms of four kinds. The network learns from spans that the rules label in a
bounded sample, from the same spans written otherwise (spaced, bracketed, without a plus sign), and
from made-up examples of both and of what only looks alike. It reads windows of 64 characters, each
32 after the one before, so that a span lies whole in one of them or is put together from two.

A span of any kind holds a digit, an at sign, or a bracketed "at". Windows without such a seed
cannot hold one and are not read; all others are. Windows are decoded by themselves; per text, what
they propose is put together, checked against what the kind demands, and reconciled with the rules'
spans, which stay, by the heaviest choice of proposals that do not overlap.
"""

from __future__ import annotations

import random
import re
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from syncloom.llm.common import named, seeded, use_package

KINDS = ("email", "ip", "card", "phone")
#: Characters of a window, and from one window to the next.
WINDOW, STRIDE = 64, 32
#: Documents that the network may learn from, and windows of each of them.
SAMPLE, WINDOWS_EACH = 2_000, 8
#: Made-up examples, and steps of 48 windows.
MADE_UP, STEPS = 1_500, 400
#: Hidden units of a direction.
HIDDEN = 16
#: Code points, and windows, that are looked at together.
POINTS, BATCH = 1 << 22, 1024

Span = tuple[int, int, int]  # kind, start, end

# --- rules ---------------------------------------------------------------------------------------

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match can only begin where a run of digits does, and takes runs whole.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]+")
_NOT_DIGIT = re.compile(r"[^0-9]+")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """From each at sign to the left as far as a name goes, to the right as far as a domain does."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (domain := _DOMAIN.match(text, at + 1)):
            end = domain.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(d * 2 - 9 * (d > 4) for d in map(int, digits[-2::-2]))) % 10 == 0


def _byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def _is_card(found: str) -> bool:
    digits = _NOT_DIGIT.sub("", found)
    return 13 <= len(digits) <= 19 and luhn(digits)


def base_spans(text: str) -> list[Span]:
    """The rules' spans, by kind as listed and then by start."""
    found = [(0, a, b) for a, b in emails(text)]
    found += [(1, *m.span()) for m in _IP.finditer(text) if all(map(_byte, m.group().split(".")))]
    found += [(2, *m.span()) for m in _CARD.finditer(text) if _is_card(m.group())]
    found += [
        (3, *m.span())
        for m in _PHONE.finditer(text)
        if 9 <= sum(map(len, _DIGITS.findall(m.group()))) <= 15
    ]
    return found


def plausible(kind: int, found: str) -> bool:
    """Whether a proposed span has what its kind demands."""
    groups = _DIGITS.findall(found)
    digits = "".join(groups)
    if kind == 0:
        return bool(_WRITTEN_EMAIL.fullmatch(found))
    if kind == 1:
        return len(groups) == 4 and all(map(_byte, groups)) and not _LETTER.search(found)
    if kind == 2:
        return 13 <= len(digits) <= 19 and luhn(digits) and not _LETTER.search(found)
    return 9 <= len(digits) <= 15 and len(groups) > 1 and bool(_WRITTEN_PHONE.fullmatch(found))


_LETTER = re.compile(r"[^\W\d_]")
_WRITTEN_EMAIL = re.compile(
    r"[A-Za-z0-9._%+-]+\s{0,2}(?:@|[\[({<]\s?(?:at|@)\s?[\])}>])\s{0,2}"
    r"[A-Za-z0-9-]+(?:\s{0,2}(?:\.|[\[({<]\s?(?:dot|\.)\s?[\])}>])\s{0,2}[A-Za-z0-9-]+)+",
    re.IGNORECASE,
)
_WRITTEN_PHONE = re.compile(r"[+(]?[0-9][0-9 ().‐-―/-]*[0-9]")

# --- symbols and windows ---------------------------------------------------------------------------

PAD, OTHER = 0, 1
_SYMBOL = np.full(129, OTHER, dtype=np.uint8)
for _i, _c in enumerate("abcdefghijklmnopqrstuvwxyz"):
    _SYMBOL[ord(_c)] = _SYMBOL[ord(_c.upper())] = 2 + _i
_SYMBOL[48:58] = 28
_SYMBOL[[9, 11, 12, 13, 32]] = 29
_SYMBOL[10] = 30
_MARKS = [c for c in range(33, 127) if not chr(c).isalnum()]
_SYMBOL[_MARKS] = 31 + np.arange(len(_MARKS))
SYMBOLS = 31 + len(_MARKS)
#: Labels: 0 is outside, then the first and the other characters of each kind.
LABELS = 1 + 2 * len(KINDS)

_BRACKETED_AT = re.compile(r"[\[({<]\s?at\s?[\])}>]", re.IGNORECASE)


def points_of(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    bounds = np.cumsum([0, *map(len, texts)])
    raw = "".join(texts).encode("utf-32-le", "surrogatepass")
    return np.frombuffer(raw, dtype="<u4"), bounds


def seeds_of(points: np.ndarray, texts: Sequence[str], bounds: np.ndarray) -> np.ndarray:
    """Places of digits, at signs and bracketed ats in the joined texts."""
    plain = ((points >= 48) & (points <= 57)) | (points == 64)
    opening = (points == 40) | (points == 60) | (points == 91) | (points == 123)
    places = np.flatnonzero(opening)
    rows = np.searchsorted(bounds, places, side="right") - 1
    bracketed = [
        p
        for p, r in zip(places.tolist(), rows.tolist(), strict=True)
        if _BRACKETED_AT.match(texts[r], p - int(bounds[r]))
    ]
    return np.union1d(np.flatnonzero(plain), np.array(bracketed, dtype=np.int64)).astype(np.int64)


def windows_of(seeds: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, start in it) of all windows that hold a seed.

    Windows begin every STRIDE characters; the last one of a text is the first to reach its end.
    """
    row = np.searchsorted(bounds, seeds, side="right") - 1
    at, size = seeds - bounds[row], bounds[row + 1] - bounds[row]
    last = -(-np.maximum(size - WINDOW, 0) // STRIDE)
    second = np.minimum(at // STRIDE, last)
    first = np.clip((at - WINDOW) // STRIDE + 1, 0, second)
    pairs = np.concatenate([np.stack([row, first]), np.stack([row, second])], axis=1)
    found = np.unique(pairs, axis=1)
    return found[0], found[1] * STRIDE


# --- the network -----------------------------------------------------------------------------------


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


@dataclass(frozen=True)
class Network:
    """Input and recurrent weights of both directions, output weights, transitions of labels.

    A character is one symbol, so its input weights are a row of a table. Gates are in the order
    input, forget, output, candidate.
    """

    tables: np.ndarray  # direction, symbol, 4 x hidden
    recurrent: np.ndarray  # direction, hidden, 4 x hidden
    output: np.ndarray  # 2 x hidden + 1, label
    moves: np.ndarray  # label, label; the last row is for the start

    def states(self, x: np.ndarray, keep: bool = False):
        """Hidden states of both directions, (window, place, 2 x hidden)."""
        n, size = x.shape
        hidden = self.recurrent.shape[1]
        out = np.empty((n, size, 2 * hidden))
        kept: list[list] = [[], []]
        for d in (0, 1):
            h, c = np.zeros((n, hidden)), np.zeros((n, hidden))
            for t in range(size) if d == 0 else range(size - 1, -1, -1):
                z = self.tables[d][x[:, t]] + h @ self.recurrent[d]
                gates = _sigmoid(z[:, : 3 * hidden])
                i, f, o = gates[:, :hidden], gates[:, hidden : 2 * hidden], gates[:, 2 * hidden :]
                g = np.tanh(z[:, 3 * hidden :])
                before, last = c, h
                c = f * c + i * g
                tc = np.tanh(c)
                h = o * tc
                out[:, t, d * hidden : (d + 1) * hidden] = h
                if keep:
                    kept[d].append((t, i, f, o, g, before, tc, last))
        return out, kept

    def scores(self, states: np.ndarray) -> np.ndarray:
        return states @ self.output[:-1] + self.output[-1]


_FORBIDDEN = np.zeros((LABELS + 1, LABELS))
for _k in range(len(KINDS)):
    # The inside of a kind follows its first character or its inside.
    _FORBIDDEN[[r for r in range(LABELS + 1) if r not in (1 + 2 * _k, 2 + 2 * _k)], 2 + 2 * _k] = -1e4


def marginals(scores: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of label scores (window, place, label): label probabilities, expected moves, log of the sum
    over all label sequences; forward and backward in scaled probabilities."""
    n, size, _ = scores.shape
    moves = moves + _FORBIDDEN
    top = scores.max(axis=2, keepdims=True)
    emit, step, start = np.exp(scores - top), np.exp(moves[:-1]), np.exp(moves[-1])
    ahead, scale = np.empty_like(emit), np.empty((n, size))
    for t in range(size):
        a = emit[:, t] * (start if t == 0 else ahead[:, t - 1] @ step)
        scale[:, t] = a.sum(axis=1)
        ahead[:, t] = a / scale[:, t][:, None]
    back = np.ones((n, emit.shape[2]))
    probability = np.empty_like(emit)
    expected = np.zeros_like(moves)
    for t in range(size - 1, -1, -1):
        probability[:, t] = ahead[:, t] * back
        if t:
            right = emit[:, t] * back / scale[:, t][:, None]
            expected[:-1] += step * (ahead[:, t - 1].T @ right)
            back = right @ step.T
    expected[-1] = probability[:, 0].sum(axis=0)
    return probability, expected, np.log(scale).sum(axis=1) + top.sum(axis=(1, 2))


def best_labels(scores: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """The best label sequence of each window."""
    n, size, labels = scores.shape
    moves = moves + _FORBIDDEN
    best = scores[:, 0] + moves[-1]
    came = np.empty((n, size, labels), dtype=np.int8)
    for t in range(1, size):
        options = best[:, :, None] + moves[:-1]
        came[:, t] = options.argmax(axis=1)
        best = options.max(axis=1) + scores[:, t]
    found = np.empty((n, size), dtype=np.int8)
    found[:, -1] = best.argmax(axis=1)
    for t in range(size - 1, 0, -1):
        found[:, t - 1] = came[np.arange(n), t, found[:, t]]
    return found


def loss_and_gradients(net: Network, x: np.ndarray, y: np.ndarray) -> tuple[float, Network]:
    """Mean negative log likelihood of the labels, and its gradients."""
    n, size = x.shape
    hidden = net.recurrent.shape[1]
    states, kept = net.states(x, keep=True)
    scores = net.scores(states)
    probability, expected, total = marginals(scores, net.moves)
    rows, places = np.arange(n)[:, None], np.arange(size)
    seen = np.zeros_like(net.moves)
    np.add.at(seen, (y[:, :-1], y[:, 1:]), 1)
    np.add.at(seen, (-1, y[:, 0]), 1)
    gold = scores[rows, places, y].sum() + (seen * net.moves).sum()
    d_scores = probability
    d_scores[rows, places, y] -= 1
    d_scores /= n
    flat = d_scores.reshape(-1, LABELS)
    d_output = np.vstack([states.reshape(-1, 2 * hidden).T @ flat, flat.sum(axis=0)])
    d_states = d_scores @ net.output[:-1].T
    d_tables, d_recurrent = np.zeros_like(net.tables), np.zeros_like(net.recurrent)
    for d in (0, 1):
        dh, dc = np.zeros((n, hidden)), np.zeros((n, hidden))
        for t, i, f, o, g, before, tc, last in reversed(kept[d]):
            dh = dh + d_states[:, t, d * hidden : (d + 1) * hidden]
            dc = dc + dh * o * (1 - tc * tc)
            dz = np.concatenate(
                [dc * g * i * (1 - i), dc * before * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)],
                axis=1,
            )
            np.add.at(d_tables[d], x[:, t], dz)
            d_recurrent[d] += last.T @ dz
            dh, dc = dz @ net.recurrent[d].T, dc * f
    return (total.sum() - gold) / n, Network(d_tables, d_recurrent, d_output, (expected - seen) / n)


def untrained(seed: int, hidden: int = HIDDEN) -> Network:
    rng = np.random.default_rng(seed)
    tables = rng.normal(0, 0.3, (2, SYMBOLS, 4 * hidden))
    tables[:, :, hidden : 2 * hidden] += 1.0  # gates that forget begin open
    return Network(
        tables,
        rng.normal(0, 1 / np.sqrt(hidden), (2, hidden, 4 * hidden)),
        rng.normal(0, 0.3, (2 * hidden + 1, LABELS)),
        np.zeros((LABELS + 1, LABELS)),
    )


def train(x: np.ndarray, y: np.ndarray, steps: int = STEPS, seed: int = 7, rate: float = 0.02) -> Network:
    """Adam over seeded batches, with a rate that falls to a tenth."""
    net, rng = untrained(seed), np.random.default_rng(seed)
    names = ("tables", "recurrent", "output", "moves")
    first, second = ({k: np.zeros_like(getattr(net, k)) for k in names} for _ in range(2))
    for t in range(1, steps + 1 if len(x) else 1):
        chosen = rng.integers(0, len(x), min(48, len(x)))
        _, slope = loss_and_gradients(net, x[chosen], y[chosen])
        now = rate * (1 - 0.9 * t / steps)
        size = np.sqrt(sum(float((getattr(slope, k) ** 2).sum()) for k in names))
        new = {}
        for k in names:
            g = getattr(slope, k) * min(1.0, 5.0 / (size + 1e-12))
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g * g
            new[k] = getattr(net, k) - now * (first[k] / (1 - 0.9**t)) / (np.sqrt(second[k] / (1 - 0.99**t)) + 1e-8)
        net = Network(**new)
    return net


# --- examples --------------------------------------------------------------------------------------


def _letters(rng: random.Random) -> str:
    return "".join(rng.choice("etaoinshrdlucmfwyp") for _ in range(rng.randint(1, 9)))


def _luhn_number(rng: random.Random, size: int, valid: bool) -> str:
    digits = rng.choice("3456") + "".join(rng.choice("0123456789") for _ in range(size - 2))
    check = next(c for c in "0123456789" if luhn(digits + c))
    return digits + (check if valid else str((int(check) + rng.randint(1, 9)) % 10))


def written_otherwise(kind: int, span: str, rng: random.Random) -> str:
    """The same personal data in a form that no rule knows."""
    if kind == 0:
        left, o = rng.choice("[({<"), rng.choice(["at", "AT", " at "])
        right = {"[": "]", "(": ")", "{": "}", "<": ">"}[left]
        sign = rng.choice([f" {left}{o}{right} ", f"{left}{o}{right}", " @ ", f"{left}@{right}", "@ "])
        dot = rng.choice([".", f" {left}dot{right} ", " . ", f"{left}.{right}"])
        name, _, host = span.partition("@")
        if sign == "@ " and dot == ".":
            dot = " . "
        return name + sign + host.replace(".", dot)
    if kind == 1:
        return span.replace(".", rng.choice([" . ", "[.]", "(.)", ". ", " ."]))
    digits = _NOT_DIGIT.sub("", span)
    if kind == 2:
        gap = rng.choice([".", "/", "  ", " - ", "_"])
        return gap.join(digits[i : i + 4] for i in range(0, len(digits), 4))
    area, middle, rest = digits[-10:-7], digits[-7:-4], digits[-4:]
    lead = digits[:-10]
    return rng.choice(
        [f"({area}) {middle}-{rest}", f"{area}-{middle}-{rest}", f"{area}.{middle}.{rest}", f"00{lead} {area} {middle} {rest}", f"({area}) {middle} {rest}", f"{area}/{middle}-{rest}"]
    )


def _plain(kind: int, rng: random.Random) -> str:
    if kind == 0:
        host = ".".join(_letters(rng) + str(rng.choice(["", rng.randint(0, 99)])) for _ in range(rng.randint(1, 2)))
        sep = rng.choice(["", ".", "_", "-"])
        return f"{_letters(rng)}{sep}{rng.choice(['', rng.randint(0, 99)])}{_letters(rng)}@{host}.{rng.choice(['com', 'org', 'net', 'de', 'example'])}"
    if kind == 1:
        return ".".join(str(rng.randint(0, 255)) for _ in range(4))
    if kind == 2:
        return _luhn_number(rng, rng.choice([13, 15, 16, 16, 16, 19]), True)
    return f"+{rng.randint(1, 99)} ({rng.randint(100, 999)}) {rng.randint(100, 999)}-{rng.randint(1000, 9999)}"


def _lookalike(rng: random.Random) -> str:
    """What holds digits or signs and is nobody's data."""
    n = lambda a, b: rng.randint(a, b)
    return rng.choice(
        [
            lambda: "".join(rng.choice("0123456789abcdef") for _ in range(rng.choice([8, 16, 32, 40]))),
            lambda: f"{n(1900, 2100)}-{n(10, 12)}-{n(10, 28)}",
            lambda: f"{n(1, 28)}.{n(1, 12)}.{n(1900, 2100)}",
            lambda: f"{n(0, 23)}:{n(10, 59)}:{n(10, 59)}",
            lambda: f"v{n(0, 20)}.{n(0, 20)}.{n(0, 20)}",
            lambda: f"{n(1, 9)}.{n(1, 9)}.{n(1, 9)}",
            lambda: f"${n(1, 999)},{n(100, 999)}.{n(10, 99)}",
            lambda: str(n(1, 10 ** rng.randint(1, 18))),
            lambda: _luhn_number(rng, 16, False),
            lambda: f"@{_letters(rng)}",
            lambda: f"{n(1, 99)}+{n(1, 99)} ({n(1, 99)})",
            lambda: f"https://{_letters(rng)}.com/{n(1, 9999)}",
            lambda: f"{_letters(rng)} (at {_letters(rng)})",
            lambda: f"{n(300, 999)}.{n(300, 999)}.{n(300, 999)}.{n(300, 999)}",
            lambda: f"pp. {n(1, 999)}-{n(1, 999)}",
            lambda: f"{n(1, 99)} x {n(1, 99)} x {n(1, 99)}",
        ]
    )()


def made_up(n: int, seed: int) -> list[tuple[str, list[Span]]]:
    """Texts of about a window and their spans, in plain form, written otherwise, and lookalikes."""
    rng, found = random.Random(seed), []
    for _ in range(n):
        text, spans = " ".join(_letters(rng) for _ in range(rng.randint(0, 5))), []
        for _ in range(rng.choice([1, 1, 2])):
            text += rng.choice([" ", ": ", ", ", "\n", " ", " = "]) if text else ""
            draw = rng.random()
            if draw < 0.3:
                text += _lookalike(rng)
            else:
                kind = rng.randrange(len(KINDS))
                body = _plain(kind, rng)
                if draw < 0.75:
                    body = written_otherwise(kind, body, rng)
                spans.append((kind, len(text), len(text) + len(body)))
                text += body
            text += rng.choice([" ", ". ", ", ", "\n", ") ", " "]) + " ".join(_letters(rng) for _ in range(rng.randint(0, 4)))
        cut = max(0, rng.randint(-40, len(text) - WINDOW)) if len(text) > WINDOW else 0
        found.append((text[cut : cut + WINDOW], [(k, a - cut, b - cut) for k, a, b in spans]))
    return found


def otherwise(text: str, spans: list[Span], rng: random.Random) -> tuple[str, list[Span]]:
    """The text with its spans written otherwise; spans that its ends cut stay as they are."""
    out, moved, at = "", [], 0
    for kind, a, b in sorted(spans, key=lambda s: s[1]):
        if a < at or b > len(text):
            continue
        out += text[at:a]
        body = written_otherwise(kind, text[a:b], rng)
        moved.append((kind, len(out), len(out) + len(body)))
        out, at = out + body, b
    return out + text[at:], moved


def arrays(examples: Sequence[tuple[str, list[Span]]]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols and labels of windows; what lies beyond a text is padding."""
    x = np.zeros((len(examples), WINDOW), dtype=np.uint8)
    y = np.zeros((len(examples), WINDOW), dtype=np.int8)
    for r, (text, spans) in enumerate(examples):
        points, _ = points_of([text[:WINDOW]])
        x[r, : len(points)] = _SYMBOL[np.minimum(points, 128)]
        for kind, a, b in spans:
            if a < len(points) and b > 0:
                y[r, max(a, 0) : min(b, len(points))] = 2 + 2 * kind
                y[r, max(a, 0)] = 1 + 2 * kind
    return x, y


def _labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows of texts about spans, lookalikes and plain prose, with the rules' spans as labels."""
    for batch in batches:
        rows = []
        for text in batch.column("text").to_pylist():
            text = text or ""
            spans = base_spans(text)
            places = [a for _, a, _ in spans][: WINDOWS_EACH - 2]
            digits = _DIGITS.search(text)
            places += [digits.start() if digits else 0, zlib.crc32(text.encode()) % (len(text) + 1)]
            for p in places:
                start = max(0, p - zlib.crc32(f"{p}:{text[p : p + 9]}".encode()) % (WINDOW - 24))
                near = [s for s in spans if s[1] < start + WINDOW and s[2] > start]
                rows.append(
                    (text[start : start + WINDOW], [k for k, _, _ in near], [a - start for _, a, _ in near], [b - start for _, _, b in near])
                )
        names = ["text", "kinds", "starts", "ends"]
        types = [pa.string(), *[pa.list_(pa.int32())] * 3]
        columns = zip(*rows, strict=True) if rows else [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


def fit(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    sample: int = SAMPLE,
    made: int = MADE_UP,
    steps: int = STEPS,
    seed: int = 7,
) -> Network:
    """A network from labelled spans.

    At most `sample` documents, those with the smallest seeded digests of their keys, give up to
    WINDOWS_EACH windows each, labelled by the rules; each window with spans comes a second time with
    them written otherwise; `made` made-up windows come on top. Null keys and null texts give none,
    an empty table leaves the made-up ones. Rows that share a key all count, up to twice the sample.
    """
    use_package(docs.sparkSession)
    rows = docs.where(named(key).isNotNull() & named(text).isNotNull())
    chosen = rows.select(named(key).alias("_k")).distinct().orderBy(seeded(seed, F.col("_k")), "_k").limit(sample)
    texts = rows.join(F.broadcast(chosen), named(key) == F.col("_k")).select(
        seeded(seed, F.col("_k"), named(text)).alias("order"), named(text).cast("string").alias("text")
    )
    # An order of its own, so that the bound does not depend on the partitions.
    bounded = texts.orderBy("order").limit(2 * sample).select("text")
    windows = bounded.mapInArrow(_labelled, "text string, kinds array<int>, starts array<int>, ends array<int>")
    found = sorted((r.text, list(zip(r.kinds, r.starts, r.ends, strict=True))) for r in windows.collect())
    return train(*arrays(examples(found, made, seed)), steps=steps, seed=seed)


def examples(
    labelled: list[tuple[str, list[Span]]], made: int, seed: int
) -> list[tuple[str, list[Span]]]:
    rng = random.Random(seed)
    held = [e for e in labelled if e[1]]
    return labelled + [otherwise(*e, rng) for e in held] + made_up(made, seed)


# --- finding -------------------------------------------------------------------------------------


def proposals(net: Network, x: np.ndarray) -> list[list[tuple[int, int, int, float]]]:
    """Per window, its spans (kind, start, end, weight); the weight sums what the label
    probabilities are above one half."""
    found: list[list] = [[] for _ in range(len(x))]
    for begin in range(0, len(x), BATCH):
        part = x[begin : begin + BATCH]
        scores = net.scores(net.states(part)[0])
        labels = best_labels(scores, net.moves)
        probability = marginals(scores, net.moves)[0]
        sure = np.take_along_axis(probability, labels[:, :, None].astype(np.int64), axis=2)[:, :, 0]
        for r in np.flatnonzero(labels.any(axis=1)):
            row = labels[r]
            starts = np.flatnonzero(row % 2 == 1)
            for s in starts:
                kind, e = (int(row[s]) - 1) // 2, int(s) + 1
                while e < WINDOW and row[e] == 2 + 2 * kind:
                    e += 1
                found[begin + r].append((kind, int(s), e, float((sure[r, s:e] - 0.5).sum())))
    return found


def put_together(found: list[tuple[int, int, int, float, bool, bool]]) -> list[tuple[int, int, int, float]]:
    """Of (kind, start, end, weight, cut on the left, cut on the right) of one text: spans, where
    what a window's edge cuts is continued by what another window found of the same kind there."""
    done: list[list] = []
    for kind, a, b, weight, left, right in sorted(set(found), key=lambda s: (s[0], s[1], s[2])):
        if done and done[-1][0] == kind and a <= done[-1][2] and (left or done[-1][4]):
            last = done[-1]
            last[3] += weight
            if b >= last[2]:
                last[2], last[4] = b, right
            continue
        done.append([kind, a, b, weight, right])
    return [tuple(s[:4]) for s in done]


def trimmed(text: str, kind: int, a: int, b: int) -> tuple[int, int]:
    """The span without blanks and marks that no such span begins or ends with."""
    begins = "+(" if kind == 3 else ""
    while a < b and not (text[a].isalnum() or text[a] in begins):
        a += 1
    while a < b and not text[b - 1].isalnum():
        b -= 1
    return a, b


def reconcile(text: str, base: list[Span], found: list[tuple[int, int, int, float]]) -> list[Span]:
    """Plausible proposals that overlap no span of the rules: the heaviest set without overlaps."""
    taken: list[list[int]] = []
    for a, b in sorted((a, b) for _, a, b in base):
        if taken and a < taken[-1][1]:
            taken[-1][1] = max(taken[-1][1], b)
        else:
            taken.append([a, b])
    begins = [a for a, _ in taken]
    options = []
    for kind, a, b, weight in found:
        a, b = trimmed(text, kind, a, b)
        if weight <= 0 or a >= b or not plausible(kind, text[a:b]):
            continue
        before = bisect_left(begins, b) - 1
        if before < 0 or taken[before][1] <= a:
            options.append((b, a, kind, weight))
    options = sorted(set(options))
    ends = [o[0] for o in options]
    best: list[tuple[float, tuple]] = [(0.0, ())]
    for i, (b, a, kind, weight) in enumerate(options):
        weighty, chain = best[bisect_right(ends, a, 0, i)]
        best.append(max(best[-1], (weighty + weight, (chain, (kind, a, b))), key=lambda x: x[0]))
    chosen, chain = [], best[-1][1]
    while chain:
        chain, span = chain
        chosen.append(span)
    return sorted(chosen)


def find_all(texts: list[str], net: Network | None) -> Iterator[tuple[list[Span], list[Span]]]:
    """Per text: the rules' spans, and the added ones."""
    start = total = 0
    for i, text in enumerate([*texts, None]):
        if text is None or (i > start and total + len(text) > POINTS):
            yield from _find_some(texts[start:i], net)
            start, total = i, 0
        total += len(text or "")


def _find_some(texts: list[str], net: Network | None) -> Iterator[tuple[list[Span], list[Span]]]:
    points, bounds = points_of(texts)
    seeds = seeds_of(points, texts, bounds)
    seeded_rows = set((np.searchsorted(bounds, seeds, side="right") - 1).tolist())
    base = [base_spans(t) if r in seeded_rows else [] for r, t in enumerate(texts)]
    added: list[list] = [[] for _ in texts]
    if net is not None and len(seeds):
        rows, starts = windows_of(seeds, bounds)
        at = (bounds[rows] + starts)[:, None] + np.arange(WINDOW)
        inside = at < bounds[rows + 1][:, None]
        x = np.where(inside, _SYMBOL[np.minimum(points[np.minimum(at, len(points) - 1)], 128)], PAD)
        # Windows that look the same are read once.
        same, place = np.unique(x, axis=0, return_inverse=True)
        found = proposals(net, same)
        for r, s, w in zip(rows.tolist(), starts.tolist(), place.ravel().tolist(), strict=True):
            size = len(texts[r])
            for kind, a, b, weight in found[w]:
                b = min(b, size - s)
                added[r].append((kind, s + a, s + b, weight, a == 0 and s > 0, b == WINDOW and s + b < size))
    for text, own, more in zip(texts, base, added, strict=True):
        yield own, reconcile(text, own, put_together(more)) if more else []


_SPANS = "array<struct<kind: string, start: long, end: long, rule: boolean>>"


def _finder(net: Network | None):
    kind_of = pa.struct(
        [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("rule", pa.bool_())]
    )

    def run(text: pa.Array) -> pa.Array:
        rows = []
        for own, more in find_all([t or "" for t in text.to_pylist()], net):
            both = [(*s, True) for s in own] + [(*s, False) for s in more]
            rows.append(
                [{"kind": KINDS[k], "start": a, "end": b, "rule": rule} for k, a, b, rule in sorted(both)]
            )
        return pa.array(rows, pa.list_(kind_of))

    return F.arrow_udf(run, _SPANS)


def find_personal_data(
    docs: DataFrame, net: Network | None, text: str = "text", out: str = "personal"
) -> DataFrame:
    """The rows with an array of spans: kind, start, end (code points, end exclusive), rule.

    Spans of the rules have `rule` true; those of one kind never overlap. Spans of the network
    overlap no other. They are sorted by kind as listed in KINDS, then by start. Without a network
    the rules' spans are all.

    A null text counts as empty and has none. Rows with the same text have the same spans. Texts of
    any length are read whole; empty tables give empty results. A column called `out` is replaced.
    """
    use_package(docs.sparkSession)
    own = [c for c in docs.columns if c.lower() != out.lower()]
    return docs.select(*map(named, own), _finder(net)(named(text).cast("string")).alias(out))


def without_spans(text: str, spans: Sequence[Span]) -> str:
    """The text with each span replaced by its kind, as in `<email>`; of spans that overlap the
    first one counts."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: s[1:]):
        if a >= at:
            out += [text[at:a], f"<{KINDS[kind]}>"]
            at = b
    return "".join([*out, text[at:]])
