"""Quality classifier by co-training two views.

The text view sees the content (byte histogram and surface statistics of the
whole text), the metadata view the other columns (source, language, length).
Each is a logistic regression.  In every round either view scores the pool, all
unlabelled documents, and hands its most confident pseudo-labels to the other
view.  Then each view is calibrated on labelled rows kept back from fitting
(Platt scaling) and the combined score adds their evidence beyond the prior.

The labelled rows are a bounded sample: at most ``max_labelled``, the first in
the order of a hash of the id, on the driver.  The pool is not bounded: its
features (about 360 numbers a document) are written once, tasks count confident
documents by confidence and hash and sum up gradients and Hessians of the handed
ones, and the driver sees only those sums.  Which documents were handed over is
worked out anew in each pass from the rounds' models and cuts.  Labels of the
held-out fold (crc32 of the id modulo 4 is 2) are never learned from.  Every
document is scored, its whole text.

Defined results: several labels of one id are averaged (0.5 counts as good), a
NULL label or id is ignored; with no label of both classes all scores are the
prior (0.5 without labels); NULL or empty text and NULL metadata have features
of their own; repeated rows each get their score; other columns are ignored.
"""

from __future__ import annotations

import zlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from citylens.llm.common import fold, materialise

HELD_OUT = 2
ROUNDS = 4
CONFIDENT = 0.95
HANDED = 0.05            # share of the pool that a view may hand over per round and class
BINS, FINE = 512, 64     # cells in which the pool is counted: by confidence, then by a hash of the id
TOP = 40.0               # logit from which confidences are equal
NEAR = 1e-2              # largest move of a round's last Newton step over the pool
MERGE = 16               # rows of sums that the driver receives

_UPPER, _DIGIT = slice(65, 91), slice(48, 58)


def text_features(text: str | None) -> np.ndarray:
    data = (text or "").encode("utf-8")
    n = max(len(data), 1)
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256).astype(np.float64)
    words, lines = data.split(), [x for x in data.split(b"\n") if x]
    n_words, n_lines = max(len(words), 1), max(len(lines), 1)
    repeats = sum(a == b for a, b in zip(words, words[1:]))
    surface = [np.log1p(len(words)), len(data) / n_words / 10, len(set(words)) / n_words, len(set(lines)) / n_lines,
               repeats / n_words, counts[_UPPER].sum() / n * 5, counts[_DIGIT].sum() / n * 5, n_words / n_lines / 50, float(not data)]
    return np.r_[np.sqrt(counts / n) * 3, surface]


def metadata_features(source: str | None, lang: str | None, n_chars: int | None) -> np.ndarray:
    out = np.zeros(64 + 16 + 14)
    out[zlib.crc32(repr(source).encode()) % 64] = 1
    out[64 + zlib.crc32(repr(lang).encode()) % 16] = 1
    size = np.log2(max(n_chars or 0, 0) + 1)
    out[80 + min(int(size / 1.5), 11)] = 1
    out[92:] = size / 10, float(n_chars is None)
    return out


class Logistic:
    """L2-regularised logistic regression by Newton's method on standardised features."""

    def __init__(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0):
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-6
        z = self._design(x)
        self.penalty = np.full(z.shape[1], ridge)
        self.penalty[-1] = 1e-3
        self.beta = np.zeros(z.shape[1])
        self.fit(lambda: self.sums(z, y, weight), 1e-4)

    def fit(self, sums, least: float) -> None:
        self.begin()
        for _ in range(12):
            if self.step(sums()) < least:
                break
        self.end(least)

    def sums(self, z: np.ndarray, y: np.ndarray, weight: np.ndarray | float) -> np.ndarray:
        """Loss, gradient and Hessian of designed rows, as one matrix; sums of parts add up."""
        logit = z @ self.beta
        p = _sigmoid(logit)
        loss = np.zeros(z.shape[1])
        loss[0] = np.sum(weight * (np.logaddexp(0, logit) - y * logit))
        return np.c_[loss, z.T @ (weight * (p - y)), (z * (weight * p * (1 - p) + 1e-6)[:, None]).T @ z]

    def begin(self) -> None:
        self.base, self.reached, self.move = None, np.inf, None

    def step(self, sums: np.ndarray) -> float:
        """One Newton step, or half of the last one if that did not lower the loss; returns its largest move."""
        loss = sums[0, 0] + 0.5 * float(self.penalty @ self.beta ** 2)
        if self.base is not None and loss > self.reached * (1 + 1e-9):
            self.move = self.move / 2
        else:
            self.base, self.reached = self.beta, loss
            self.move = np.linalg.solve(sums[:, 2:] + np.diag(self.penalty), sums[:, 1] + self.penalty * self.beta)
        self.beta = self.base - self.move
        return float(np.abs(self.move).max())

    def end(self, least: float) -> None:
        """A last step that is not known to lower the loss does not count."""
        if np.abs(self.move).max() >= least:
            self.beta = self.base
        self.base = self.move = None

    def _design(self, x: np.ndarray) -> np.ndarray:
        return np.c_[np.clip((x - self.mean) / self.scale, -6, 6), np.ones(len(x))]

    def logit(self, x: np.ndarray) -> np.ndarray:
        return self._design(x) @ self.beta


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def _cells(logit: np.ndarray, fine: np.ndarray) -> np.ndarray:
    """Cell of each confident logit: the most confident first, equal ones by hash."""
    least = np.log(CONFIDENT / (1 - CONFIDENT))
    step = (TOP - np.minimum(logit, TOP)) / (TOP - least) * (BINS - 1)
    return step.astype(np.int64) * FINE + fine


class Round:
    """The views' coefficients in one round, and per view that has chosen the first cell not handed over, of good and bad."""

    def __init__(self, betas: list[np.ndarray]):
        self.betas, self.cuts = betas, []


def _confident(z: np.ndarray, beta: np.ndarray, free: np.ndarray, fine: np.ndarray):
    """Per class (good, bad): free confident rows and their cells."""
    logit = z @ beta
    for sign in (1, -1):
        sure = np.flatnonzero(free & (sign * logit >= np.log(CONFIDENT / (1 - CONFIDENT))))
        yield sure, _cells(sign * logit[sure], fine[sure])


def _handed(rounds: list[Round], z: list[np.ndarray], fine: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per row the view that received it (-1: none) and its pseudo-label."""
    to, label = np.full(len(fine), -1), np.zeros(len(fine))
    for r in rounds:
        for v, cuts in enumerate(r.cuts):
            chosen = [sure[cells < cut] for (sure, cells), cut in zip(_confident(z[v], r.betas[v], to < 0, fine), cuts)]
            for rows, y in zip(chosen, (1.0, 0.0)):
                to[rows], label[rows] = 1 - v, y
    return to, label


def _count(views: list[Logistic], rounds: list[Round], v: int, x: list[np.ndarray], fine: np.ndarray) -> np.ndarray:
    """Free rows of which view v is confident in the last round, by class and cell."""
    z = [m._design(a) for m, a in zip(views, x)]
    to, _ = _handed(rounds, z, fine)
    return np.concatenate([np.bincount(cells, minlength=BINS * FINE) for _, cells in _confident(z[v], rounds[-1].betas[v], to < 0, fine)]).astype(float)


def _sums(views: list[Logistic], rounds: list[Round], x: list[np.ndarray], fine: np.ndarray) -> np.ndarray:
    """Both views' gradients and Hessians over the rows that they received."""
    z = [m._design(a) for m, a in zip(views, x)]
    to, label = _handed(rounds, z, fine)
    return np.concatenate([m.sums(z[v][to == v], label[to == v], 0.5).ravel() for v, m in enumerate(views)])


def _cut(counts: np.ndarray, most: int) -> int:
    """First cell not handed over: at most ``most`` rows before it, but at least the first cell with rows."""
    first = np.flatnonzero(counts)
    return max(int(np.searchsorted(np.cumsum(counts), most, side="right")), int(first[0]) + 1) if first.size else 0


class LocalPool:
    """A pool in memory."""

    def __init__(self, x: list[np.ndarray]):
        self.x, self.size = x, len(x[0])
        self.fine = np.arange(self.size) % FINE

    def total(self, function) -> np.ndarray:
        return function(self.x, self.fine)


class CoTrained:
    """Two calibrated views and the prior log-odds; ``score`` combines them."""

    def __init__(self, views: list[np.ndarray], y: np.ndarray, pool, rounds: int = ROUNDS):
        """``pool``: a list of the views' features, or a pool object, or a function that makes one."""
        y = y.astype(np.float64)
        share = float(y.mean()) if len(y) else 0.5
        self.prior = float(np.log((share + 1e-3) / (1 - share + 1e-3)))
        self.views, self.platt = [], []
        if len(y) < 20 or share in (0.0, 1.0):
            return
        pool = LocalPool(pool) if isinstance(pool, list) else pool() if callable(pool) else pool
        back = np.arange(len(y)) % 5 == 4                                     # kept back for calibration
        self.views = [Logistic(x[~back], y[~back], np.ones((~back).sum())) for x in views]
        known = [m._design(x[~back]) for m, x in zip(self.views, views)]
        done: list[Round] = []
        most = max(1, int(pool.size * HANDED))
        for _ in range(rounds if pool.size else 0):
            done.append(Round([m.beta for m in self.views]))
            for v in range(2):
                counts = pool.total(partial(_count, self.views, done, v)).reshape(2, -1)
                done[-1].cuts.append([_cut(c, most) for c in counts])
            if not any(map(any, done[-1].cuts)):
                break
            for m in self.views:
                m.begin()
            for _ in range(12):
                sums, at, moves = pool.total(partial(_sums, self.views, done)), 0, []
                for m, z in zip(self.views, known):
                    n = len(m.beta)
                    moves.append(m.step(m.sums(z, y[~back], 1.0) + sums[at:at + n * (n + 2)].reshape(n, n + 2)))
                    at += n * (n + 2)
                if max(moves) < NEAR:
                    break
            for m in self.views:
                m.end(NEAR)
        for v in range(2):
            self.platt.append(Logistic(self.views[v].logit(views[v][back])[:, None], y[back], np.ones(back.sum()), ridge=0.1))

    def score(self, text: np.ndarray, metadata: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Combined, text and metadata probabilities."""
        if not self.views:
            p = np.full(len(text), float(_sigmoid(self.prior)))
            return p, p, p
        a, b = (c.logit(v.logit(x)[:, None]) for c, v, x in zip(self.platt, self.views, (text, metadata)))
        return _sigmoid(a + b - self.prior), _sigmoid(a), _sigmoid(b)


def _features(rows: list) -> list[np.ndarray]:
    texts = [text_features(r["text"]) for r in rows]
    meta = [metadata_features(r["source"], r["lang"], r["n_chars"]) for r in rows]
    return [np.array(texts).reshape(len(rows), -1), np.array(meta).reshape(len(rows), -1)]


class SparkPool:
    """All documents without a label, each id once; ``total`` adds up a function of blocks of them."""

    def __init__(self, docs: DataFrame, known: DataFrame):
        def run(batches):
            for b in batches:
                for start in range(0, b.num_rows, 1000):
                    part = b.slice(start, 1000)
                    x = [np.ascontiguousarray(v, dtype=np.float32) for v in _features(part.to_pylist())]
                    yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array([r.tobytes() for r in v], pa.binary()) for v in x)],
                                                     names=["doc_id", "text_x", "meta_x"])

        kind = docs.schema["doc_id"].dataType.simpleString()
        rows = docs.where("doc_id is not null").mapInArrow(run, f"doc_id {kind}, text_x binary, meta_x binary")
        first = F.row_number().over(Window.partitionBy("doc_id").orderBy("text_x", "meta_x"))
        once = rows.withColumn("nth", first).where("nth = 1").join(known.select("doc_id"), "doc_id", "left_anti")
        self.rows = materialise(once.select(F.pmod(F.xxhash64("doc_id"), F.lit(FINE)).cast("int").alias("fine"), "text_x", "meta_x"), "quality-pool")
        self.size = self.rows.count()

    def total(self, function) -> np.ndarray:
        def run(batches):
            held = None
            for b in batches:
                if b.num_rows:
                    x = [np.frombuffer(b"".join(b.column(c).to_pylist()), np.float32).reshape(b.num_rows, -1).astype(np.float64) for c in ("text_x", "meta_x")]
                    part = function(x, b.column("fine").to_numpy())
                    held = part if held is None else held + part
            if held is not None:
                yield pa.RecordBatch.from_arrays([pa.array([held.tobytes()], pa.binary())], names=["part"])

        def merge(batches):
            held = None
            for b in batches:
                for blob in b.column("part").to_pylist():
                    part = np.frombuffer(blob)
                    held = part if held is None else held + part
            if held is not None:
                yield pa.RecordBatch.from_arrays([pa.array([held.tobytes()], pa.binary())], names=["part"])

        got = self.rows.mapInArrow(run, "part binary").repartition(MERGE).mapInArrow(merge, "part binary").collect()
        return sum(np.frombuffer(bytes(r["part"])) for r in got)


def _sample_features(docs: DataFrame, chosen: DataFrame) -> tuple[list[np.ndarray], np.ndarray]:
    """Features of a bounded, broadcast choice of ids, computed by Spark; rows in hash order."""

    def run(batches):
        for b in batches:
            text, meta = _features(b.to_pylist())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("y"), pa.array(list(text.astype(np.float32)), pa.list_(pa.float32())),
                 pa.array(list(meta.astype(np.float32)), pa.list_(pa.float32()))], names=["doc_id", "y", "text_x", "meta_x"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    one = F.min(F.struct("text", "source", "lang", "n_chars")).alias("r")                 # a repeated id counts once
    got = (docs.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "y").agg(one).select("doc_id", "y", "r.*")
           .mapInArrow(run, f"doc_id {kind}, y double, text_x array<float>, meta_x array<float>").collect())
    got.sort(key=lambda r: (zlib.crc32(str(r["doc_id"]).encode()), str(r["doc_id"]), r["text_x"], r["meta_x"]))
    shape = [text_features("").size, metadata_features(None, None, None).size]
    return [np.array([r[c] for r in got], dtype=np.float64).reshape(len(got), n) for c, n in zip(("text_x", "meta_x"), shape)], \
        np.array([r["y"] for r in got], dtype=np.float64)


def train(docs: DataFrame, labels: DataFrame, max_labelled: int = 8_000) -> CoTrained:
    """Fit on ``docs(doc_id, text, source, lang, n_chars)`` and ``labels(doc_id, quality)``."""
    order = F.xxhash64("doc_id")
    known = materialise(labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.avg("quality").alias("q")), "labels")
    learn = known.where(fold() != HELD_OUT).select("doc_id", (F.col("q") >= 0.5).cast("double").alias("y"))
    labelled = docs.sparkSession.createDataFrame(learn.orderBy(order, "doc_id").limit(max_labelled).collect(), learn.schema)
    x, y = _sample_features(docs, labelled)
    return CoTrained(x, y, lambda: SparkPool(docs, known))


def score_quality(docs: DataFrame, labels: DataFrame, **sample) -> DataFrame:
    """Per document: ``doc_id, held_out, score`` (chance of good quality), ``text_score``,
    ``metadata_score``, ``quality_pred``."""
    slim = docs.select("doc_id", "text", "source", "lang", "n_chars")
    model = docs.sparkSession.sparkContext.broadcast(train(slim, labels.select("doc_id", "quality"), **sample))

    def run(batches):
        for b in batches:
            for start in range(0, b.num_rows, 1000):
                part = b.slice(start, 1000)
                scores = model.value.score(*_features(part.to_pylist()))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), *(pa.array(s, pa.float64()) for s in scores)],
                    names=["doc_id", "held_out", "score", "text_score", "metadata_score"])

    kind = slim.schema["doc_id"].dataType.simpleString()
    return (slim.withColumn("held_out", F.coalesce(fold() == HELD_OUT, F.lit(False)))
            .mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, text_score double, metadata_score double")
            .withColumn("quality_pred", (F.col("score") >= 0.5).cast("int")))
