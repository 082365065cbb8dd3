"""Operator 10: quality classifier by co-training.

Two logistic classifiers see different views of a document: the words of its
text, and its metadata (source, language, recorded length, and the page's
layout in counts, without its words).  A word counts by its evidence, the
standard score of its shares in good and other documents.  In each round both
views score all unlabelled documents; the surest of them, by quantiles over
all, are pseudo-labelled for the other view.  Word evidence is counted anew
over the labelled and all pseudo-labelled documents, so that a view can teach
the other words that no label has shown.  The views' outputs are then
calibrated together on labelled rows set aside, and score every document.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmart.llm._store import materialize, without
from clickmart.llm._words import LOWER, SPACED, hashes, slices, utf8, words

OUT = ("text_score", "meta_score", "score", "kept")
DIMS = 1 << 20  # hashed words: a rare word seldom falls on a telling one
#: Standard scores below this are chance; a word needs more to count for the text view.
MIN_EVIDENCE = 3.0
#: What a pseudo-label weighs at most, and all together against the labels.
PSEUDO_WEIGHT = 0.1
N_SOURCES, N_LANGS, N_LAYOUT = 64, 32, 12
META = ("source", "lang", "n_chars")


def text_view(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed words of each document (punctuation apart, A-Z lower-cased): features, and n + 1 offsets."""
    apart = SPACED.copy()
    apart[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = False
    buf = LOWER[data]
    starts, ends, first = words(buf, bounds, apart)
    feature = (hashes(buf, starts, ends) & np.uint64(DIMS - 1)).astype(np.int64)
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(first))
    pair = np.unique(doc * DIMS + feature)
    return pair % DIMS, np.searchsorted(pair // DIMS, np.arange(len(bounds)))


def layout(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Counts about a document's form: its length, lines, words, signs, and how much of it repeats."""
    n = len(bounds) - 1
    lens = np.maximum(np.diff(bounds), 1)

    def share(*ranges) -> np.ndarray:
        table = np.zeros(256, np.int64)
        for a, b in ranges:
            table[a:b] = 1
        total = np.concatenate([[0], np.cumsum(table[data])])
        return (total[bounds[1:]] - total[bounds[:-1]]) / lens

    starts, ends, first = words(data, bounds, SPACED)
    h, count = hashes(data, starts, ends), np.maximum(np.diff(first), 1)
    doc = np.repeat(np.arange(n), np.diff(first))
    by_doc = np.lexsort((h, doc))
    new = np.r_[True, (h[by_doc][1:] != h[by_doc][:-1]) | (doc[by_doc][1:] != doc[by_doc][:-1])] if len(h) else np.zeros(0, bool)
    distinct = np.bincount(doc[by_doc][new], minlength=n)
    after = np.bincount(doc[1:][(h[1:] == h[:-1]) & (doc[1:] == doc[:-1])], minlength=n) if len(h) else np.zeros(n)
    return np.stack([
        np.log1p(lens) / 10, np.log1p(count) / 10, share((0x0A, 0x0B)) * 50, share((0x30, 0x3A)) * 10,
        share((0x41, 0x5B)) * 10, share((0x21, 0x30), (0x3A, 0x41), (0x5B, 0x61), (0x7B, 0x7F)) * 10,
        share((0x23, 0x27), (0x2A, 0x2B), (0x3C, 0x3D), (0x3E, 0x3F), (0x7C, 0x7D)) * 10, share((0x80, 0x100)) * 2,
        share((0x20, 0x21)) * 5, distinct / count, 2 * after / count, np.log1p(lens / count)], axis=1)


def meta_view(data: np.ndarray, bounds: np.ndarray, source: np.ndarray, lang: np.ndarray, n_chars: np.ndarray) -> np.ndarray:
    """Dense metadata features; ``source`` and ``lang`` are hashes, ``n_chars`` is 0 where unknown."""
    n = len(bounds) - 1
    out = np.zeros((n, N_SOURCES + N_LANGS + N_LAYOUT + 1))
    out[np.arange(n), source % N_SOURCES] = 1
    out[np.arange(n), N_SOURCES + lang % N_LANGS] = 1
    out[:, N_SOURCES + N_LANGS:-1] = layout(data, bounds)
    out[:, -1] = np.log1p(np.maximum(n_chars, 0)) / 10
    return out


def dampen(n: np.ndarray) -> np.ndarray:
    """What a document of ``n`` distinct words multiplies its words' weights by; long documents are not silenced."""
    return 1 / np.log(np.e + n)


def word_evidence(bad: np.ndarray, good: np.ndarray, all_bad: float, all_good: float) -> np.ndarray:
    """Evidence of words from the weights of the documents of each class that have them, and of all documents of the class."""
    all_bad, all_good = max(all_bad, 1e-9), max(all_good, 1e-9)
    p = (bad + good) / (all_bad + all_good)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12) * (1 / all_bad + 1 / all_good))
    return np.maximum(np.abs(bad / all_bad - good / all_good) / spread - MIN_EVIDENCE, 0) / 4


class Sparse:
    """Rows of binary features.  Each counts by its evidence: how far its shares of the two classes are apart.

    The evidence is the standard score of that difference on the rows of
    weight above 0, less ``MIN_EVIDENCE``; features of no evidence are left
    out, so that a few telling words are not lost among thousands of others.
    """

    def __init__(self, rows: list[np.ndarray], y: np.ndarray, weight: np.ndarray, evidence: np.ndarray | None = None):
        n = np.array([len(r) for r in rows], np.int64)
        at, row = np.concatenate([np.zeros(0, np.int64), *rows]), np.repeat(np.arange(len(rows)), n)
        if evidence is None:
            total = [(weight * side).sum() for side in (1 - y, y)]
            evidence = word_evidence(*(np.bincount(at, (weight * side)[row], minlength=DIMS) for side in (1 - y, y)), *total)
        told = evidence[at] > 0
        self.ids, self.at = np.unique(at[told], return_inverse=True)
        self.row, self.n, self.evidence = row[told], len(rows), evidence[self.ids]
        self.value = dampen(n)[self.row] * self.evidence[self.at]
        self.dims = len(self.ids)

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.at] * self.value, minlength=self.n)

    def back(self, r: np.ndarray) -> np.ndarray:
        return np.bincount(self.at, r[self.row] * self.value, minlength=self.dims)

    def spread_out(self, w: np.ndarray) -> np.ndarray:
        """Weights of all hashed features."""
        out = np.zeros(DIMS)
        out[self.ids] = w * self.evidence
        return out


class Dense:
    def __init__(self, x: np.ndarray):
        self.x, self.dims = x, x.shape[1]

    def dot(self, w: np.ndarray) -> np.ndarray:
        return self.x @ w

    def back(self, r: np.ndarray) -> np.ndarray:
        return r @ self.x


def fit_logistic(x, y: np.ndarray, weight: np.ndarray, w: np.ndarray, b: float, decay: float, steps: int = 60):
    """Weighted logistic regression by full-batch Adam, from (w, b) on.  Rows of weight 0 do not count."""
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    total = max(weight.sum(), 1e-9)
    for t in range(1, steps + 1):
        r = (1 / (1 + np.exp(-np.clip(x.dot(w) + b, -30, 30))) - y) * weight / total
        g, gb = x.back(r) + decay * w, r.sum()
        m, v, mb, vb = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g, 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        step = 0.3 * np.sqrt(1 - 0.99 ** t) / (1 - 0.9 ** t)
        w, b = w - step * m / (np.sqrt(v) + 1e-8), b - step * mb / (np.sqrt(vb) + 1e-8)
    return w, b


@dataclass
class Model:
    text: tuple[np.ndarray, float]
    meta: tuple[np.ndarray, float]
    #: Weights of the views' logits and the constant of the joint calibration; slope and constant of each view's own.
    joint: tuple[float, float, float]
    own: tuple[tuple[float, float], tuple[float, float]]


#: Logits beyond this are no surer; it keeps one view from silencing the other.
MAX_LOGIT = 8.0


def _calibrate(logits: np.ndarray, y: np.ndarray, steps: int = 2000) -> np.ndarray:
    """Logistic regression on a few logits by gradient descent, shrunk to an equal share each; slopes are not negative."""
    x = np.c_[logits, np.ones(len(y))]
    start = np.r_[np.full(logits.shape[1], 1 / logits.shape[1]), 0.0]
    w = start.copy()
    rate = 1 / (0.25 * (x * x).sum(axis=1).mean() + 0.01)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w = w - rate * (x.T @ (p - y) / len(y) + 0.01 * (w - start))
        w[:-1] = np.maximum(w[:-1], 0)
    return w


def _rows_of(binary: pa.Array, kind) -> tuple[np.ndarray, np.ndarray]:
    """Values of all rows one after the other, and the row of each."""
    parts = [np.frombuffer(x, kind) for x in binary.to_pylist()]
    return np.concatenate([np.zeros(0, kind), *parts]), np.repeat(np.arange(len(parts)), [len(x) for x in parts])


def _logits(text: tuple[np.ndarray, float], meta: tuple[np.ndarray, float]):
    """Both views' logits of feature rows (text, meta binary)."""
    def run(words: pa.Array, dense: pa.Array) -> pa.Array:
        at, row = _rows_of(words, np.int32)
        n = np.bincount(row, minlength=len(words))
        z = np.bincount(row, text[0][at], minlength=len(words)) * dampen(n) + text[1]
        x = _rows_of(dense, np.float32)[0].reshape(len(words), -1)
        return pa.StructArray.from_arrays([pa.array(z), pa.array(x @ meta[0] + meta[1])], ["text", "meta"])
    return F.arrow_udf(run, "struct<text: double, meta: double>")


def _class_counts(batches):
    """(feature, bad, good): weights of the rows (text, y, weight) that have a word, summed over a task."""
    count = np.zeros((2, DIMS))
    for b in batches:
        at, row = _rows_of(b.column(0), np.int32)
        y, weight = (b.column(k).to_numpy(zero_copy_only=False).astype(float) for k in (1, 2))
        for k, side in enumerate((1 - y, y)):
            count[k] += np.bincount(at, (weight * side)[row], minlength=DIMS)
    told = np.flatnonzero(count.any(axis=0))
    yield pa.RecordBatch.from_arrays([pa.array(told), pa.array(count[0][told]), pa.array(count[1][told])], names=["feature", "bad", "good"])


def counted_evidence(rows: DataFrame) -> np.ndarray:
    """Evidence of all hashed words over the training rows (text, y, weight), counted on all of them."""
    totals = rows.agg(F.sum(F.col("weight") * (1 - F.col("y"))).alias("bad"), F.sum(F.col("weight") * F.col("y")).alias("good")).first()
    out = np.zeros(DIMS)
    if totals["bad"] is None:
        return out
    counts = (rows.select("text", F.col("y").cast("double"), F.col("weight").cast("double")).mapInArrow(_class_counts, "feature long, bad double, good double")
              .groupBy("feature").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")))
    got = counts.toArrow()  # at most one row for each of the DIMS hashed words
    feature = got.column("feature").to_numpy()
    out[feature] = word_evidence(got.column("bad").to_numpy(), got.column("good").to_numpy(), totals["bad"], totals["good"])
    return out


def pseudo_labels(scored: DataFrame, by: str, share_good: float, share: float) -> DataFrame:
    """Of the pool rows of ``scored`` (kind, text_z, meta_z) those of which view ``by`` is surest, with y.

    ``share`` of all pool rows is asked for, divided as the labels are; cut-offs are quantiles over all pool rows.
    """
    z = F.col(f"{by}_z")
    pool = scored.where("kind = 2")
    cuts = pool.agg(F.percentile_approx(z, [share * (1 - share_good), 1 - share * share_good], 10_000)).first()[0]
    if cuts is None:
        return pool.withColumn("y", F.lit(0)).limit(0)
    low, high = cuts
    sure = F.when((z >= high) & (z > 0), 1).when((z <= low) & (z < 0), 0)
    return pool.withColumn("y", sure).where("y is not null")


def co_train(rows: DataFrame, rounds: int = 3, per_round: float = 0.05, max_fitted: int = 4000) -> Model | None:
    """Co-train on feature rows (doc_id, y, kind, text, meta); ``kind``: 0 labelled, 1 set aside for calibration, 2 unlabelled.

    Pseudo-labels together weigh at most ``PSEUDO_WEIGHT`` of what the labels do.  Quantiles
    and word evidence are taken over all rows; the logistic weights are fitted
    on the labelled rows and a sample of at most about ``max_fitted``
    pseudo-labelled ones for a view.
    """
    def local(df: DataFrame) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        got = sorted(zip(*(df.select("doc_id", "text", "meta", "y").toArrow().column(n).to_pylist() for n in ("doc_id", "text", "meta", "y"))),
                     key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        dense = np.stack([np.frombuffer(r[2], np.float32) for r in got]).astype(float) if got else np.zeros((0, N_SOURCES + N_LANGS + N_LAYOUT + 1))
        return [np.frombuffer(r[1], np.int32).astype(np.int64) for r in got], dense, np.array([r[3] for r in got], float)

    labelled, aside = local(rows.where("kind = 0")), local(rows.where("kind = 1"))  # bounded by max_labelled of ``fit``
    if any(len({*part[2]}) < 2 for part in (labelled, aside)):
        return None
    n_labelled, share_good = len(labelled[2]), float(labelled[2].mean())
    known = rows.where("kind = 0").select("text", "y", F.lit(1.0).alias("weight"))
    nothing = ([], labelled[1][:0], labelled[2][:0])
    lessons, weights, evidence = {"text": nothing, "meta": nothing}, {"text": 0.0, "meta": 0.0}, counted_evidence(known)
    text, meta = (np.zeros(DIMS), 0.0), (np.zeros(labelled[1].shape[1]), 0.0)
    for r in range(rounds + 1):
        steps = 120 if r == 0 else 40
        words, _, y = (a + b if isinstance(a, list) else np.concatenate([a, b]) for a, b in zip(labelled, lessons["text"]))
        weight = np.r_[np.ones(n_labelled), np.full(len(y) - n_labelled, weights["text"])]
        view = Sparse(words, y, weight, evidence)
        start = text[0][view.ids] / np.where(view.evidence > 0, view.evidence, 1)
        w, b = fit_logistic(view, y, weight, start, text[1], 1e-4, steps)
        text = (view.spread_out(w), float(b))
        _, dense, y = (a + b if isinstance(a, list) else np.concatenate([a, b]) for a, b in zip(labelled, lessons["meta"]))
        weight = np.r_[np.ones(n_labelled), np.full(len(y) - n_labelled, weights["meta"])]
        v, c = fit_logistic(Dense(dense), y, weight, *meta, 1e-4, steps)
        meta = (v, float(c))
        if r == rounds:
            break
        scored = rows.withColumn("z", _logits(text, meta)("text", "meta")).withColumns({"text_z": F.col("z.text"), "meta_z": F.col("z.meta")})
        for learner, teacher in (("text", "meta"), ("meta", "text")):
            taught = materialize(pseudo_labels(scored, teacher, share_good, per_round * (r + 1)).select("doc_id", "text", "meta", "y"), "pseudo-labels")
            n = taught.count()
            each = min(PSEUDO_WEIGHT, PSEUDO_WEIGHT * n_labelled / max(n, 1))
            rate = min(1.0, max_fitted / max(n, 1))
            lessons[learner] = local(taught.where(_unit(F.col("doc_id"), F.lit("lesson")) < rate))
            weights[learner] = each / rate if n else 0.0
            if learner == "text":
                evidence = counted_evidence(known.unionByName(taught.select("text", "y", F.lit(each).alias("weight"))))
    words, dense, y = aside
    n = np.array([len(x) for x in words])
    z = np.stack([np.array([text[0][x].sum() for x in words]) * dampen(n) + text[1], dense @ meta[0] + meta[1]], axis=1)
    z = np.clip(z, -MAX_LOGIT, MAX_LOGIT)
    joint = _calibrate(z, y)
    own = [tuple(_calibrate(z[:, [i]], y)) for i in (0, 1)]
    return Model((text[0].astype(np.float32), text[1]), (meta[0].astype(np.float32), meta[1]), tuple(joint), tuple(own))


def _views(text: pa.Array, source: pa.Array, lang: pa.Array, n_chars: pa.Array):
    """Slices of a batch as (text features, offsets, meta features)."""
    data, offsets = utf8(text)
    s, g, c = (x.to_numpy(zero_copy_only=False).astype(np.int64) for x in (source, lang, n_chars))
    for i, j in slices(offsets):
        buf, bounds = data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        yield (*text_view(buf, bounds), meta_view(buf, bounds, s[i:j], g[i:j], c[i:j]))


def _inputs(docs: DataFrame) -> list[Column]:
    """text, hashes of source and lang, n_chars; a column that is missing counts as null."""
    have = {c.lower() for c in docs.columns}
    source, lang = (F.pmod(F.xxhash64(F.col(c).cast("string") if c in have else F.lit(None).cast("string")), F.lit(1 << 20)) for c in ("source", "lang"))
    n_chars = F.coalesce(F.col("n_chars").cast("long"), F.lit(0)) if "n_chars" in have else F.lit(0).cast("long")
    return [F.col("text").cast("string"), source, lang, n_chars]


def _unit(*columns) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*columns), 11) / F.lit(float(1 << 53))


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = 6000, held_out: int = 1) -> Model | None:
    """Co-train on at most about ``max_labelled`` labelled documents and on all others.

    A document is good if its quality is 1 and it is not toxic; of repeated
    labels the worst counts.  Labelled rows are drawn by a hash of the doc_id;
    the third of the ids with crc32 modulo 3 of ``held_out`` is never labelled
    training data.  Features of all documents are written once.  None if
    there are no labels of both kinds.
    """
    good = (F.coalesce("quality", F.lit(0)) == 1) & (F.coalesce("toxic", F.lit(0)) == 0)
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    known = (labels.where("doc_id is not null and (quality is not null or toxic is not null)").groupBy("doc_id")
             .agg(F.min(good.cast("int")).alias("__y")).where(fold != held_out))
    n_known = known.count()
    u = _unit(F.col("doc_id"), F.lit("labelled"))
    sample = known.where(u < min(1.0, max_labelled / max(n_known, 1)))
    # The labelled sample is bounded by max_labelled rows.
    wanted = (docs.join(F.broadcast(sample), "doc_id", "left")
              .withColumn("__kind", F.when(F.col("__y").isNull(), 2).when(_unit(F.col("doc_id"), F.lit("aside")) < 0.25, 1).otherwise(0)))

    def features(batches):
        for b in batches:
            rows = 0
            for at, offsets, meta in _views(*b.columns[:4]):
                n = len(meta)
                yield pa.RecordBatch.from_arrays([
                    b.column(4).slice(rows, n), b.column(5).slice(rows, n), b.column(6).slice(rows, n),
                    pa.array([at[x:y].astype(np.int32).tobytes() for x, y in zip(offsets[:-1], offsets[1:])], pa.binary()),
                    pa.array([m.astype(np.float32).tobytes() for m in meta], pa.binary())], names=["doc_id", "y", "kind", "text", "meta"])
                rows += n

    rows = (wanted.select(*[c.alias(f"c{i}") for i, c in enumerate(_inputs(docs))], F.col("doc_id").cast("long"),
                          F.coalesce("__y", F.lit(0)).cast("int").alias("y"), F.col("__kind").cast("int").alias("kind"))
            .mapInArrow(features, "doc_id long, y int, kind int, text binary, meta binary"))
    return co_train(materialize(rows, "view-features"))


def score(docs: DataFrame, model: Model | None, threshold: float = 0.5) -> DataFrame:
    """Every row of ``docs`` (text, source, lang, n_chars, any others) with text_score, meta_score, score (0 to 1) and kept.

    ``kept``: score of at least ``threshold`` and a text with a word.  A null
    or missing metadata column is a value of its own; null text is an empty
    one.  Without a model (no usable labels) scores are null and every
    document with a word is kept.  Input columns named like an output are
    replaced.
    """
    base = without(docs, *OUT)
    has_word = F.coalesce(F.length(F.translate("text", " \t\n\x0b\x0c\r", "")) > 0, F.lit(False))
    if model is None:
        return base.withColumns({c: F.lit(None).cast("double") for c in OUT[:3]}).withColumn("kept", has_word)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # weights of a fixed number of features

    @F.arrow_udf("struct<text_score: double, meta_score: double, score: double>")
    def scored(text: pa.Array, source: pa.Array, lang: pa.Array, n_chars: pa.Array) -> pa.Array:
        m = shared.value
        z = [np.zeros((0, 2))]
        for at, offsets, meta in _views(text, source, lang, n_chars):
            total = np.concatenate([[0.0], np.cumsum(m.text[0][at], dtype=np.float64)])
            n = np.diff(offsets)
            z.append(np.stack([(total[offsets[1:]] - total[offsets[:-1]]) * dampen(n) + m.text[1],
                               meta @ m.meta[0].astype(float) + m.meta[1]], axis=1))
        z = np.clip(np.concatenate(z), -MAX_LOGIT, MAX_LOGIT)
        a, b, c = m.joint
        lines = [m.own[0][0] * z[:, 0] + m.own[0][1], m.own[1][0] * z[:, 1] + m.own[1][1], a * z[:, 0] + b * z[:, 1] + c]
        return pa.StructArray.from_arrays([pa.array(1 / (1 + np.exp(-np.clip(x, -30, 30)))) for x in lines], list(OUT[:3]))

    return (base.withColumn("__score", scored(*_inputs(docs))).select(*base.columns, "__score.*")
            .withColumn("kept", has_word & (F.col("score") >= threshold)))
