"""Quality classifier by positive-unlabelled learning with the non-negative risk.

Trusted positives and unlabelled text train a linear model: the risk of positives counts at the
class prior, and the risk of negatives is what the unlabelled risk leaves after the positives'
share, held at zero or above. The prior is estimated from scores alone, and so is the shift that
makes the scores of all unlabelled rows sum up to it.

Features are written once. A bounded sample says where the descent begins; then sums over all
unlabelled rows, one row for each task, give the risk and its slopes, the spread of the features, the
prior and the shift. Documents known to be bad play no part, unless they are given to calibrate with.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from syncloom.llm.common import Scratch, named, seeded, use_package

#: At most so many texts that are labelled train the model, and so many others say where it begins.
SAMPLE = 8_000
#: Steps over all unlabelled rows.
PASSES = 5
#: Bins of log odds between -30 and 30.
BINS = 600
#: Cells that word shapes are hashed into.
SHAPE_CELLS = 256
FOLDS = 5

_UPPER = np.zeros(256, dtype=bool)
_UPPER[65:91] = True
_SHAPES = bytes(
    (
        ord("A") if 65 <= b <= 90 else ord("a") if 97 <= b <= 122 else ord("0") if 48 <= b <= 57
        else ord("u") if b >= 128 else b
    )
    for b in range(256)
)


# --- features ----------------------------------------------------------------------------------


def features(text: bytes | None) -> np.ndarray:
    """Shares of kinds of bytes and words, and of hashed word shapes; zeros for no words."""
    out = np.zeros(16 + SHAPE_CELLS, dtype=np.float32)
    words = text.split() if text else []
    if not words:
        return out
    n = len(words)
    counts = np.bincount(np.frombuffer(text, dtype=np.uint8), minlength=256).astype(np.float64)
    total = counts.sum()
    distinct = len(set(words))
    pairs = len(set(zip(words, words[1:], strict=False)))
    lines = [x for x in text.split(b"\n") if x.strip()]
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=n)
    out[:16] = (
        1.0,
        np.log1p(n) / 10,
        counts[65:91].sum() / total,
        counts[97:123].sum() / total,
        counts[48:58].sum() / total,
        counts[128:].sum() / total,
        counts[[33, 34, 39, 40, 41, 44, 45, 46, 58, 59, 63]].sum() / total,
        counts[[35, 36, 37, 38, 42, 60, 62, 92, 94, 95, 123, 124, 125, 126]].sum() / total,
        counts[33] / total,
        counts[46] / total,
        distinct / n,
        pairs / max(n - 1, 1),
        lengths.mean() / 10,
        lengths.std() / 10,
        len(set(lines)) / len(lines),
        np.log1p(n / len(lines)) / 10,
    )
    shapes = text.translate(_SHAPES).split()
    # A shape is the first two and the last three kinds of bytes.
    cells = np.fromiter(
        (zlib.crc32(s[:2] + b"\0" + s[-3:]) for s in shapes), dtype=np.int64, count=n
    )
    out[16:] = np.sqrt(np.bincount(cells % SHAPE_CELLS, minlength=SHAPE_CELLS) / n)
    return out


# --- learning ----------------------------------------------------------------------------------


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    prior: float
    slope: float = 1.0
    shift: float = 0.0

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        z = ((x - self.mean) / self.scale).astype(np.float64)
        return np.clip(z @ self.weights[:-1] + self.weights[-1], -30, 30)

    def scores(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.slope * self.log_odds(x) + self.shift)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def nn_risk(weights, positive, unlabelled, prior: float) -> tuple[float, np.ndarray, float]:
    """Logistic non-negative risk, the gradient to follow, and its negative part.

    Where the negative part falls below zero, the gradient undoes that instead.
    """
    zp, zu = positive @ weights, unlabelled @ weights
    soft = lambda z: np.logaddexp(0, z)
    part = soft(zu).mean() - prior * soft(zp).mean()
    grad_part = unlabelled.T @ _sigmoid(zu) / len(zu) - prior * positive.T @ _sigmoid(zp) / len(zp)
    grad_plus = -prior * positive.T @ _sigmoid(-zp) / len(zp)
    risk = prior * soft(-zp).mean() + max(part, 0.0)
    return risk, (grad_plus + grad_part if part >= 0 else -grad_part), part


def _descend(positive, unlabelled, prior: float, steps: int, rate: float, decay: float, seed: int):
    """Adam over seeded batches of both kinds."""
    rng = np.random.default_rng(seed)
    w = np.zeros(positive.shape[1])
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        p = positive[rng.integers(0, len(positive), min(512, len(positive)))]
        u = unlabelled[rng.integers(0, len(unlabelled), min(512, len(unlabelled)))]
        _, g, _ = nn_risk(w, p, u, prior)
        g = g + decay * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """The share of positives among the unlabelled, from scores of rows not learnt from.

    Above a cut, the unlabelled hold at least the prior times what the positives hold, and just
    that where no negative scores so high. So each cut bounds the prior; the lower quartile over
    cuts that half to nearly all positives pass is taken, as the least one is mostly noise.
    """
    cuts = np.quantile(positive, np.linspace(0.02, 0.5, 49))
    ratios = [(unlabelled >= c).mean() / max((positive >= c).mean(), 1e-9) for c in cuts]
    return float(np.clip(np.quantile(ratios, 0.25), 0.05, 0.98))


def _halves(x: np.ndarray) -> list[np.ndarray]:
    """Two halves that depend on the rows alone, so that equal rows stay together."""
    side = np.array([zlib.crc32(r.tobytes()) & 1 for r in x], dtype=bool)
    return [x[~side], x[side]]


def halves_weights(positive, unlabelled, mean, scale, steps: int, seed: int) -> list[np.ndarray]:
    """Weights from either half of the rows, with equal weight for both kinds; empty without rows."""
    one = lambda x: np.hstack([(x - mean) / scale, np.ones((len(x), 1))]).astype(np.float64)
    pairs = zip(_halves(positive), _halves(unlabelled), strict=True)
    return [
        _descend(one(p), one(u), 0.5, steps, 0.01, 1e-2, seed) for p, u in pairs if len(p) and len(u)
    ]


def train(
    positive: np.ndarray, unlabelled: np.ndarray, steps: int = 3000, seed: int = 7
) -> Model:
    """A model from feature rows; with hardly any rows of a kind every score is one half.

    For the prior, positives and unlabelled are told apart with equal weights, and each half of the
    rows is scored by what the other half taught.
    """
    width = 16 + SHAPE_CELLS
    if len(positive) < 8 or len(unlabelled) < 8:
        return Model(np.zeros(width + 1), np.zeros(width), np.ones(width), 0.5)
    mean, scale = unlabelled.mean(axis=0), unlabelled.std(axis=0) + 1e-2
    one = lambda x: np.hstack([(x - mean) / scale, np.ones((len(x), 1))]).astype(np.float64)
    p, u = one(positive), one(unlabelled)
    positives, others = _halves(p), _halves(u)
    scored: tuple[list, list] = ([], [])
    for k in (0, 1):
        if len(positives[k]) and len(others[k]):
            w = _descend(positives[k], others[k], 0.5, steps // 3, 0.01, 1e-2, seed)
            scored[0].append(positives[1 - k] @ w)
            scored[1].append(others[1 - k] @ w)
    held_p, held_u = (np.concatenate([np.empty(0), *x]) for x in scored)
    prior = estimate_prior(held_p, held_u) if len(held_p) and len(held_u) else 0.5
    return Model(_descend(p, u, prior, steps, 0.01, 1e-3, seed), mean, scale, prior)


def calibrate(model: Model, good: np.ndarray, bad: np.ndarray, steps: int = 50) -> Model:
    """The model with a slope and a shift that fit known documents, each kind at its prior share.

    Newton steps on the logistic loss, held back a little; the slope stays positive, so the order
    of scores does. With hardly any rows of a kind the model stays as it is.
    """
    if len(good) < 8 or len(bad) < 8:
        return model
    z = np.concatenate([model.log_odds(good), model.log_odds(bad)])
    y = np.concatenate([np.ones(len(good)), np.zeros(len(bad))])
    share = np.where(y > 0, model.prior / len(good), (1 - model.prior) / len(bad))
    x, w = np.stack([z, np.ones_like(z)], axis=1), np.array([1.0, 0.0])
    for _ in range(steps):
        p = _sigmoid(x @ w)
        slope = x.T @ (share * (p - y)) + 1e-4 * (w - [1.0, 0.0])
        curve = (x * (share * p * (1 - p))[:, None]).T @ x + 1e-4 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        w = w - step / max(1.0, np.abs(step).max())
    return replace(model, slope=float(max(w[0], 0.1)), shift=float(w[1]))


# --- with Spark --------------------------------------------------------------------------------


def held_out(key: Column, folds: int = FOLDS) -> Column:
    """Whether the row is of the fold that nothing is learnt from; a null key is."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % folds == 0


def featurised(docs: DataFrame, text: str = "text", out: str = "features") -> DataFrame:
    """The rows with the features of their text as bytes, the text itself left out."""
    use_package(docs.sparkSession)
    own = [c for c in docs.columns if c.lower() not in (out.lower(), text.lower())]
    return docs.select(*map(named, own), F.arrow_udf(_features_of, "binary")(named(text)).alias(out))


def _features_of(text: pa.Array) -> pa.Array:
    return pa.array([features(t).tobytes() for t in text.cast(pa.binary()).to_pylist()], pa.binary())


def _matrix(column: pa.Array) -> np.ndarray:
    rows = [v for v in column.to_pylist() if v is not None]
    return np.frombuffer(b"".join(rows), dtype=np.float32).reshape(len(rows), 16 + SHAPE_CELLS)


def training_rows(
    rows: DataFrame, keys: DataFrame, sample: int, seed: int, key: str, column: str = "features"
) -> np.ndarray:
    """Features of at most `sample` of the keys, all rows of a key, up to twice the sample.

    Keys are drawn by a seeded digest, and where rows have to be left out, those with the largest
    digests are; so the partitions play no part.
    """
    chosen = (
        keys.where(named(key).isNotNull())
        .select(named(key).alias("_k"))
        .distinct()
        .orderBy(seeded(seed, F.col("_k")), "_k")
        .limit(sample)
    )
    found = rows.join(F.broadcast(chosen), named(key) == F.col("_k")).select(named(column).alias("x"))
    drawn = found.orderBy(F.md5("x"), "x").limit(2 * sample).collect()
    if not drawn:
        return np.empty((0, 16 + SHAPE_CELLS), np.float32)
    return np.stack(sorted((np.frombuffer(r[0], np.float32) for r in drawn), key=lambda r: r.tobytes()))


def summed(rows: DataFrame, work: Callable[[np.ndarray], np.ndarray], width: int, column: str = "features") -> np.ndarray:
    """The sum over all rows of what the work makes of blocks of features: vectors of this width.

    Tasks add up their own rows, a few tasks add up these, and the driver has what is left: as many
    vectors as a square root of the tasks.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                total += work(_matrix(batch.column("x").slice(start, 4096)))
        yield pa.RecordBatch.from_pydict({"v": pa.array([total.tobytes()], pa.binary())})

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for batch in batches:
            for value in batch.column("v").to_pylist():
                total += np.frombuffer(value)
        yield pa.RecordBatch.from_pydict({"v": pa.array([total.tobytes()], pa.binary())})

    parts = rows.select(named(column).alias("x")).mapInArrow(partial, "v binary")
    few = max(1, math.isqrt(max(1, rows.rdd.getNumPartitions())))
    vectors = parts.repartition(few).mapInArrow(again, "v binary").collect()
    return np.sum(sorted((np.frombuffer(r[0]) for r in vectors), key=lambda v: v.tobytes()), axis=0)


def _standard(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    return np.hstack([(x - mean) / scale, np.ones((len(x), 1))]).astype(np.float64)


def risk_sums(x: np.ndarray, w: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Of unlabelled rows: the risk of taking them for positives, its slope, its curve, by weight."""
    z_rows = _standard(x, mean, scale)
    z = z_rows @ w
    p = _sigmoid(z)
    return np.concatenate([[np.logaddexp(0, z).sum()], p @ z_rows, (p * (1 - p)) @ z_rows**2])


def _moments(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    return np.concatenate([[len(x)], x.sum(axis=0), (x * x).sum(axis=0)])


def fit_features(
    rows: DataFrame,
    trusted: DataFrame,
    rejected: DataFrame | None = None,
    key: str = "doc_id",
    sample: int = SAMPLE,
    passes: int = PASSES,
    seed: int = 7,
) -> Model:
    """The model of `fit`, from a written table of keys and features."""
    positive = training_rows(rows, trusted, sample, seed, key)
    start = training_rows(rows, rows.select(named(key)), sample, seed + 1, key)
    model = train(positive, start, seed=seed)
    if len(positive) < 8 or len(start) < 8:
        return model
    width = 16 + SHAPE_CELLS
    count, *sums = summed(rows, _moments, 1 + 2 * width)
    mean = np.array(sums[:width]) / count
    scale = np.sqrt(np.maximum(np.array(sums[width:]) / count - mean**2, 0)) + 1e-2
    prior = model.prior
    either = halves_weights(positive, start, mean, scale, 1000, seed)
    if len(either) == 2:
        scored = [_standard(x, mean, scale) @ w for x, w in zip(_halves(positive), either[::-1], strict=True)]
        held = np.concatenate(scored)
        cuts = np.quantile(held, np.linspace(0.02, 0.5, 49))

        def above(x: np.ndarray) -> np.ndarray:
            """Rows at or above each cut, each scored by the half that it is not of."""
            z = np.concatenate([_standard(h, mean, scale) @ w for h, w in zip(_halves(x), either[::-1], strict=True)])
            return len(z) - np.searchsorted(np.sort(z), cuts, side="left")

        shares = summed(rows, above, len(cuts)) / count
        ratios = shares / np.maximum([(held >= c).mean() for c in cuts], 1e-9)
        prior = float(np.clip(np.quantile(ratios, 0.25), 0.05, 0.98))
    p_rows = _standard(positive, mean, scale)
    # The same weights over the spread of all rows.
    w = np.append(model.weights[:-1] * scale / model.scale, model.weights[-1] + model.weights[:-1] @ ((mean - model.mean) / model.scale))
    best = (np.inf, w)
    for step in range(passes + 1):
        found = summed(rows, lambda x, w=w: risk_sums(x, w, mean, scale), 1 + 2 * (width + 1)) / count
        zp = p_rows @ w
        sp = _sigmoid(zp)
        part = found[0] - prior * np.logaddexp(0, zp).mean()
        risk = prior * np.logaddexp(0, -zp).mean() + max(part, 0.0)
        if risk < best[0]:
            best = (risk, w)
        if step == passes:
            break
        slope_part = found[1 : width + 2] - prior * p_rows.T @ sp / len(p_rows)
        slope_plus = -prior * p_rows.T @ (1 - sp) / len(p_rows)
        slope = slope_plus + slope_part if part >= 0 else -slope_part
        curve = found[width + 2 :] + prior * (p_rows**2).T @ (sp * (1 - sp)) / len(p_rows) + 1e-2
        w = w - 0.2 * np.clip((slope + 1e-3 * w) / curve, -1, 1)
    model = Model(best[1], mean, scale, prior)
    edges = np.linspace(-30, 30, BINS + 1)
    bins = summed(rows, lambda x: np.histogram(model.log_odds(x), edges)[0].astype(float), BINS)
    model = replace(model, shift=prior_shift(bins, edges, prior))
    if rejected is None:
        return model
    return calibrate(model, positive, training_rows(rows, rejected, sample, seed, key))


def prior_shift(bins: np.ndarray, edges: np.ndarray, prior: float) -> float:
    """What to add to log odds so that their scores have the prior as their mean."""
    middles, low, high = (edges[1:] + edges[:-1]) / 2, -30.0, 30.0
    for _ in range(60):
        shift = (low + high) / 2
        if (bins * _sigmoid(middles + shift)).sum() < prior * bins.sum():
            low = shift
        else:
            high = shift
    return round(shift, 9)


def fit(
    docs: DataFrame,
    trusted: DataFrame,
    rejected: DataFrame | None = None,
    key: str = "doc_id",
    text: str = "text",
    sample: int = SAMPLE,
    seed: int = 7,
) -> Model:
    """A model from the documents whose keys are trusted, against all documents given.

    Trusted keys are cut to `sample`, drawn by a seeded digest of the key; a key that repeats brings
    all its rows, up to twice the sample. As many unlabelled rows say where the descent begins; the
    descent itself, the spread, the prior and the shift of the scores are sums over all documents.
    Trusted keys without a document, and null keys among them, are left out. Rejected keys are an
    option that departs from positives and unlabelled text alone: they calibrate the scores.

    Null and empty texts are rows without features. With hardly any rows of a kind, an empty table
    among them, every score is one half.
    """
    rows = Scratch(docs.sparkSession, "quality").write(
        featurised(docs.select(named(key), named(text)), text), "features"
    )
    return fit_features(rows, trusted, rejected, key, sample, seed=seed)


def score_features(rows: DataFrame, model: Model, column: str = "features", out: str = "score") -> DataFrame:
    """The rows with the score of their features in place of these."""
    use_package(rows.sparkSession)

    def scored(x: pa.Array) -> pa.Array:
        return pa.array(model.scores(_matrix(x)), pa.float64())

    own = [c for c in rows.columns if c.lower() not in (out.lower(), column.lower())]
    return rows.select(*map(named, own), F.arrow_udf(scored, "double")(named(column)).alias(out))


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """The rows with a score of 0 to 1 in a column `out`, which is replaced if it is there.

    Each row is scored by its text alone; null and empty texts get the score of no features.
    Repeated rows get equal scores, and an empty table an empty result.
    """
    use_package(docs.sparkSession)

    def scored(texts: pa.Array) -> pa.Array:
        found = [features(t) for t in texts.cast(pa.binary()).to_pylist()]
        x = np.stack(found) if found else np.empty((0, 16 + SHAPE_CELLS), np.float32)
        return pa.array(model.scores(x), pa.float64())

    own = [c for c in docs.columns if c.lower() != out.lower()]
    return docs.select(*map(named, own), F.arrow_udf(scored, "double")(named(text)).alias(out))
