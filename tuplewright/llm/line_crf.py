"""Document quality from a linear-chain CRF over lines.

Every line is labelled good or bad given features of its own and of the
lines before and after; transitions between labels are weights as well.  The
marginals of forward-backward, weighted by line length, give the document's raw
quality, a number from 0 to 1; a logistic curve of that number alone, fitted on the
training documents, is the score.

Training uses all lines of at most ``max_docs`` labelled documents, the first by a
hash of their id: a bounded sample whatever the size of the corpus.  Every line of
a document carries the document's label.  A chain of more than ``RUN`` lines
trains as runs of so many successive lines, with the features of the whole text.
Scoring reads whole texts.

Defined results: a null or empty text is one empty line; blank lines count as
lines of length 0, with a weight of one code point; null labels don't train;
with fewer than two labels in the sample every score is the sample's mean label
(0.5 without a sample).  Null ids are scored, not trained on; repeated rows are
kept; other columns are ignored.  Of several texts of one id the least trains,
and of several labels the least counts.
"""
from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_schema, pick, schema, small_batches, text_or_empty

_UPPER = bytes(range(65, 91))
_DIGITS = b"0123456789"
_SYMBOLS = b"!#$%&*+/<=>@\\^_`{|}~"
_CLAUSE = b".,;:?"
OWN = 12
#: Own features that are also taken from the lines before and after.
SHARED = (1, 2, 4, 6, 7)
N_FEATURES = 1 + OWN + 2 * len(SHARED) + 2
#: Lines whose features are held at once.
SLAB = 8192
#: Successive lines of one training chain.
RUN = 1024


def _own_features(lines: list[str]) -> np.ndarray:
    own = np.zeros((len(lines), OWN))
    for i, line in enumerate(lines):
        n = len(line)
        if not n:
            continue
        raw = line.encode("utf-8", "surrogatepass")
        size = len(raw)
        words = raw.split()
        m = len(words) or 1
        distinct = set(words)
        symbols = size - len(raw.translate(None, _SYMBOLS))
        own[i] = (
            math.log1p(n),
            (size - len(raw.translate(None, _UPPER))) / size,
            symbols / m,
            (size - len(raw.translate(None, _DIGITS))) / size,
            len(distinct) / m,
            min(size / m, 40.0),
            sum(map(bytes.__eq__, words[1:], words)) / m,
            raw.count(b"|") / m,
            (size - len(raw.translate(None, _CLAUSE))) / m,
            line.rstrip().endswith((".", "?", "!", '"', "”")),
            line[:1].isupper(),
            raw.isupper(),
        )
    return own


def feature_slabs(lines: list[str]):
    """The features of the lines (bias first), ``SLAB`` lines at a time: a text
    of any number of lines takes a fixed amount of memory for its features."""
    last = len(lines) - 1
    for at in range(0, len(lines), SLAB):
        end = min(at + SLAB, len(lines))
        low, high = max(at - 1, 0), min(end + 1, len(lines))
        own = _own_features(lines[low:high])
        padded = np.vstack([np.zeros((int(low == at), OWN)), own, np.zeros((int(high == end), OWN))])
        ends = np.zeros((end - at, 2))
        ends[0, 0], ends[-1, 1] = at == 0, end - 1 == last
        yield np.hstack([np.ones((end - at, 1)), padded[1:-1], padded[:-2][:, SHARED], padded[2:][:, SHARED], ends])


def line_weights(lines: list[str]) -> np.ndarray:
    """Per line its length in code points, 1 if blank."""
    return np.fromiter((len(line) or 1 for line in lines), float, len(lines))


def line_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Features and weights of all lines of a text."""
    lines = text.split("\n")
    return np.vstack(list(feature_slabs(lines))), line_weights(lines)


def log_odds(unary: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Log-odds of good over bad at each line; ``unary``: score of good minus
    bad; ``moves[a, b]``: score of label a, then b (0 bad, 1 good)."""
    n = len(unary)
    if n == 1:
        return unary.copy()
    (bb, bg), (gb, gg) = moves.tolist()
    forward, backward, u = [0.0] * n, [0.0] * n, unary.tolist()

    def add(a: float, b: float) -> float:
        return a + math.log1p(math.exp(b - a)) if a > b else b + math.log1p(math.exp(a - b))

    x = u[0]
    forward[0] = x
    for i in range(1, n):  # log-odds message from the left
        x = u[i] + add(x + gg, bg) - add(x + gb, bb)
        forward[i] = x
    y = 0.0
    for i in range(n - 2, -1, -1):
        y += u[i + 1]
        y = add(gg + y, gb) - add(bg + y, bb)
        backward[i] = y
    return np.array(forward) + np.array(backward)


class Model:
    """Weights, scales, moves and the logistic curve."""

    def __init__(self, mean, scale, weights, moves, curve):
        self.mean, self.scale, self.weights, self.moves, self.curve = mean, scale, weights, moves, curve

    def unary(self, features: np.ndarray) -> np.ndarray:
        return ((features - self.mean) / self.scale) @ self.weights

    def marginal(self, unary: np.ndarray, weight: np.ndarray) -> float:
        """The mean marginal of a good line, weighted by length."""
        odds = np.clip(log_odds(unary, self.moves), -30, 30)
        return float(weight @ (1 / (1 + np.exp(-odds))) / weight.sum())

    def score(self, text: str) -> float:
        lines = text.split("\n")
        unary = np.concatenate([self.unary(slab) for slab in feature_slabs(lines)])
        z = self.curve[0] + self.curve[1] * self.marginal(unary, line_weights(lines))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def _chain_gradient(unary, moves, labels, lengths):
    """Log-likelihood and its gradients for padded chains (docs, lines)."""
    docs, longest = unary.shape
    alpha = np.zeros((longest, docs, 2))
    beta = np.zeros((longest, docs, 2))
    u = np.stack([np.zeros_like(unary), unary], axis=2).transpose(1, 0, 2)
    alive = np.arange(longest)[:, None] < lengths[None, :]
    alpha[0] = u[0]
    for t in range(1, longest):
        step = np.logaddexp(alpha[t - 1][:, :1] + moves[0], alpha[t - 1][:, 1:] + moves[1]) + u[t]
        alpha[t] = np.where(alive[t][:, None], step, alpha[t - 1])
    for t in range(longest - 2, -1, -1):
        nxt = beta[t + 1] + u[t + 1]
        step = np.logaddexp(nxt[:, :1] + moves[:, 0], nxt[:, 1:] + moves[:, 1])
        beta[t] = np.where(alive[t + 1][:, None], step, 0.0)
    z = np.logaddexp(alpha[-1][:, 0], alpha[-1][:, 1])
    marginal = np.exp(np.clip(alpha[..., 1] + beta[..., 1] - z, -700, 0)).T
    pair = np.exp(np.clip(alpha[:-1, :, :, None] + moves[None, None] + (beta[1:] + u[1:])[:, :, None, :] - z[None, :, None, None], -700, 0))
    pair *= alive[1:, :, None, None]
    steps = np.maximum(lengths - 1, 0)
    observed = np.zeros((2, 2))
    observed[0, 0], observed[1, 1] = steps[labels == 0].sum(), steps[labels == 1].sum()
    own = (unary * alive.T).sum(axis=1)
    likelihood = (np.where(labels == 1, own + steps * moves[1, 1], steps * moves[0, 0]) - z).sum()
    return likelihood, (labels[:, None] - marginal) * alive.T, observed - pair.sum(axis=(0, 1))


def fit(examples: list[tuple[np.ndarray, np.ndarray, int]], rounds: int = 150, ridge: float = 1.0) -> Model:
    """Adam on the chain likelihood, in order of length; then the curve by Newton."""
    neutral = Model(np.zeros(N_FEATURES), np.ones(N_FEATURES), np.zeros(N_FEATURES), np.zeros((2, 2)), np.zeros(2))
    labels = np.array([y for *_, y in examples], float)
    if not len(examples) or labels.min() == labels.max():
        mean = min(max(labels.mean(), 1e-6), 1 - 1e-6) if len(examples) else 0.5
        neutral.curve[0] = math.log(mean / (1 - mean))
        return neutral
    stacked = np.vstack([f for f, *_ in examples])
    mean, scale = stacked.mean(axis=0, dtype=float), stacked.std(axis=0, dtype=float)
    mean[0], scale[scale < 1e-9] = 0.0, 1.0
    chains = [(f[at : at + RUN], y) for f, _, y in examples for at in range(0, len(f), RUN)]
    lengths, of = np.array([len(f) for f, _ in chains]), np.array([y for _, y in chains], float)
    order = np.argsort(lengths, kind="stable")
    groups = []
    for part in np.array_split(order, max(1, len(order) // 256)):
        longest = lengths[part].max()
        x = np.zeros((len(part), longest, N_FEATURES))
        for i, k in enumerate(part):
            x[i, : lengths[k]] = (chains[k][0] - mean) / scale
        groups.append((x, of[part], lengths[part]))
    theta = np.zeros(N_FEATURES + 4)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, rounds + 1):
        gradient = np.zeros_like(theta)
        w, moves = theta[:N_FEATURES], theta[N_FEATURES:].reshape(2, 2)
        for x, y, n in groups:
            _, du, dm = _chain_gradient(x @ w, moves, y, n)
            gradient[:N_FEATURES] += np.einsum("dl,dlf->f", du, x)
            gradient[N_FEATURES:] += dm.ravel()
        gradient = (gradient - ridge * theta) / len(examples)
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        theta = theta + 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    model = Model(mean, scale, theta[:N_FEATURES], theta[N_FEATURES:].reshape(2, 2), np.zeros(2))
    z = np.array([[1.0, model.marginal(model.unary(f), w)] for f, w, _ in examples])
    curve = np.zeros(z.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ curve, -30, 30)))
        hessian = (z * (p * (1 - p))[:, None]).T @ z + 0.1 * np.eye(len(curve))
        move = np.linalg.solve(hessian, z.T @ (labels - p) - 0.1 * curve)
        curve = curve + move
        if np.abs(move).max() < 1e-9:
            break
    model.curve = curve
    return model


def held_out(id_col: Column, parts: int = 4, part: int = 2) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % parts == part, F.lit(True))


def train(docs: DataFrame, labels: DataFrame, max_docs: int = 3000, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model:
    spark = docs.sparkSession
    small_batches(spark)
    known = pick(labels, id=id_col, y=label_col).where(F.col("id").isNotNull() & F.col("y").isin(0, 1) & ~held_out(F.col("id")))
    chosen = known.groupBy("id").agg(F.min("y").alias("y")).orderBy(F.xxhash64(F.col("id").cast("string")), "id").limit(max_docs)
    chosen = spark.createDataFrame(chosen.collect(), schema(("id", known.schema["id"].dataType), ("y", known.schema["y"].dataType)))
    out = schema(("key", "string"), ("y", "int"), ("features", "binary"), ("weights", "binary"))

    def run(batches):
        to = arrow_schema(out)
        for batch in batches:
            for key, text, y in zip(*(batch.column(c).to_pylist() for c in ("id", "text", "y"))):
                features, weights = line_features(text)
                values = [[f"{key}"], [int(y)], [features.astype(np.float32).tobytes()], [weights.astype(np.float32).tobytes()]]
                yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(values, to)], schema=to)

    texts = pick(docs, id=id_col, text=text_col).withColumn("text", text_or_empty("text"))
    # At most `max_docs` rows on the broadcast side, and as many groups.
    rows = texts.join(F.broadcast(chosen), "id").groupBy("id").agg(F.min("text").alias("text"), F.min("y").alias("y")).mapInArrow(run, out).collect()
    examples = [(np.frombuffer(r.features, np.float32).reshape(-1, N_FEATURES), np.frombuffer(r.weights, np.float32).astype(float), r.y) for r in sorted(rows, key=lambda r: r.key)]
    return fit(examples)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", cut: float = 0.7) -> DataFrame:
    """``id_col``, held_out, score, predicted (1 if score >= cut)."""
    spark = docs.sparkSession
    small_batches(spark)
    base = pick(docs, id=id_col, text=text_col).withColumn("text", text_or_empty("text"))
    scored = base.select("id", score_column(spark, model)("text").alias("score"))
    return scored.select(F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"))


def score_column(spark, model: Model):
    """An Arrow function: text -> score."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        model = shared.value
        return pa.array([model.score(t or "") for t in texts.to_pylist()], pa.float64())

    return scored
