"""Operator 5: language by hierarchical discrimination.

Linear support vector machines first tell the language family, then
one-versus-one machines tell the languages within it.  Features are the shares
of hashed byte pairs and triples in the whole text, A-Z lower-cased; a
machine's decision is then the mean of its weights over the text's positions,
so scoring reads each byte once and needs no feature vectors.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmart.llm._store import without
from clickmart.llm._words import LOWER, slices, utf8

#: Families of languages; a language that is not listed is a family of its own.
FAMILIES = {"en": "germanic", "de": "germanic", "nl": "germanic", "sv": "germanic", "da": "germanic", "no": "germanic",
            "fr": "romance", "es": "romance", "it": "romance", "pt": "romance", "ro": "romance", "ca": "romance"}
OUT = ("lang_pred", "score")
DIMS = 4096  # half for pairs, half for triples
_HALF = DIMS // 2
_BLOCK = 128  # rows or columns worked on at a time, where a whole copy would be large

#: Digits count as 0, other ASCII signs as a space.
_CLASS = LOWER.copy()
_CLASS[:0x61] = np.where((_CLASS[:0x61] >= 0x61), _CLASS[:0x61], 0x20)
_CLASS[0x30:0x3A] = 0x30
_CLASS[0x7B:0x80] = 0x20


def gram_index(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature index of the pair and of the triple that start at each byte (shorter at the end)."""
    c = _CLASS[buf].astype(np.uint32)
    b = np.append(c[1:], 0x20).astype(np.uint32)
    d = np.append(b[1:], 0x20).astype(np.uint32)
    pair = (c * np.uint32(0x9E3779B1) + b * np.uint32(0x85EBCA77)) >> np.uint32(21)
    triple = (c * np.uint32(0x9E3779B1) + b * np.uint32(0x85EBCA77) + d * np.uint32(0xC2B2AE3D)) >> np.uint32(21)
    return pair, triple + np.uint32(_HALF)


def features(data: bytes) -> np.ndarray:
    """Shares of all pairs and triples; sums to 2 (0 for an empty text)."""
    buf = np.frombuffer(data, np.uint8)
    if not len(buf):
        return np.zeros(DIMS, np.float32)
    pair, triple = gram_index(buf)
    return ((np.bincount(pair, minlength=DIMS) + np.bincount(triple, minlength=DIMS)) / len(buf)).astype(np.float32)


def deviations(x: np.ndarray) -> np.ndarray:
    """``x.std(axis=0)``, some columns at a time, so that no copy of ``x`` is made."""
    return np.concatenate([x[:, i:i + _BLOCK].std(axis=0) for i in range(0, x.shape[1], _BLOCK)])


def fit_svm(x: np.ndarray, y: np.ndarray, steps: int = 150, decay: float = 1e-3) -> tuple[np.ndarray, float, float]:
    """Squared-hinge linear SVM by accelerated gradient descent on scaled features.

    Returns weights and bias for unscaled features, and the slope that makes a
    margin a probability (logistic, fitted on the training margins).  ``x`` is
    overwritten: a machine's worker holds its rows once.
    """
    scale = 1.0 / (deviations(x) + 1e-4)
    mean = x.mean(axis=0)
    z = x  # scaled in place
    z -= mean
    z *= scale
    norm = np.sqrt(np.concatenate([(z[i:i + _BLOCK] ** 2).sum(axis=1) for i in range(0, len(z), _BLOCK)]).mean()) or 1.0
    z /= norm
    share = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1))
    w, b, vw, vb = np.zeros(z.shape[1]), 0.0, np.zeros(z.shape[1]), 0.0
    for t in range(steps):
        look_w, look_b = w + 0.9 * vw, b + 0.9 * vb
        slack = np.maximum(0, 1 - y * (z @ look_w + look_b)) * y * share
        vw = 0.9 * vw + 0.25 * (2 * slack @ z - decay * look_w)
        vb = 0.9 * vb + 0.25 * 2 * slack.sum()
        w, b = w + vw, b + vb
    margin, slope = z @ w + b, 2.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * margin * y, -30, 30)))
        slope = float(np.clip(slope + 0.5 * (((1 - p) * margin * y * share).sum() - 1e-3 * slope), 0.5, 20))
    weights = w * scale / norm
    return weights.astype(np.float32), float(b - mean @ weights), slope


@dataclass
class Model:
    """Machines by pair (a, b): positive margins vote for a.  ``families``: name to its languages."""
    families: dict[str, list[str]] = field(default_factory=dict)
    machines: dict[tuple[str, str], tuple[np.ndarray, float, float]] = field(default_factory=dict)


def _vote(names: list[str], margins: dict[tuple[str, str], np.ndarray], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Index of the winner by votes (ties: larger summed probability, then name) and its mean probability."""
    if len(names) == 1:
        return np.zeros(n, np.int64), np.ones(n)
    votes, proba = np.zeros((n, len(names))), np.zeros((n, len(names)))
    for (i, a), (j, b) in itertools.combinations(enumerate(names), 2):
        p = margins[a, b]
        votes[:, i] += p >= 0.5
        votes[:, j] += p < 0.5
        proba[:, i] += p
        proba[:, j] += 1 - p
    best = np.argmax(votes + proba / (2 * len(names)), axis=1)
    return best, proba[np.arange(n), best] / (len(names) - 1)


def predict_batch(column: pa.Array, model: Model) -> tuple[list[str], np.ndarray]:
    """Language and score of each text of an Arrow column, from the whole text."""
    data, offsets = utf8(column)
    langs, scores = [], []
    pairs = list(model.machines)
    for i, j in slices(offsets):
        buf, bounds = data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        lens = np.diff(bounds)
        n = j - i
        inside = bounds[:-1][lens > 0]
        # The last pair and triples of a text end in a space, not in the next text.
        apart = np.insert(buf, np.repeat(bounds[1:], 2), 0x20) if n else buf
        shift = bounds + 2 * np.arange(n + 1)
        pair, triple = gram_index(apart)
        proba = {}
        for key in pairs:
            w, b, slope = model.machines[key]
            total = np.zeros(len(apart) + 1)
            np.cumsum(w[pair] + w[triple], out=total[1:])
            margin = (total[shift[:-1] + lens] - total[shift[:-1]]) / np.maximum(lens, 1) + b
            proba[key] = 1 / (1 + np.exp(-np.clip(slope * margin, -30, 30)))
        del inside
        names = sorted(model.families)
        family, score = _vote(names, proba, n)
        pick = {name: _vote(model.families[name], proba, n) for name in names}
        for k in range(n):
            name = names[family[k]]
            best, inner = pick[name]
            langs.append(model.families[name][best[k]])
            scores.append(float(score[k] * inner[k]))
    return langs, np.array(scores)


def training_matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Sides and features of a machine's rows (side, x), in the order of both, so that a fit does not hang on the rows' order.

    The features go from the Arrow buffers to their places; there is no copy beside the result.
    """
    order = pc.sort_indices(table.select(["side", "x"]), sort_keys=[("side", "ascending"), ("x", "ascending")]).to_numpy()
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    x, i = np.empty((len(order), DIMS)), 0
    for chunk in table["x"].chunks:
        data, offsets = utf8(chunk)
        x[place[i:i + len(chunk)]] = data[offsets[0]:offsets[-1]].view(np.float32).reshape(len(chunk), DIMS)
        i += len(chunk)
    return table["side"].to_numpy().astype(np.float64)[order], x


def fit(labelled: DataFrame, per_language: int = 600, families: dict[str, str] = FAMILIES) -> Model:
    """Fit on (text, lang, key): about ``per_language`` rows for each language.

    The sample is bounded: rows are chosen by a hash of ``key``, at a rate
    from the language's row count.  Each machine is fitted in a task of its
    own on its own languages' rows.  Null or empty texts and null lang are
    left out.
    """
    rows = labelled.where("lang is not null and length(text) > 0")
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    members: dict[str, list[str]] = {}
    for lang in sorted(counts):
        members.setdefault(families.get(lang, lang), []).append(lang)
    model = Model(members)
    # (machine, language, side): families against each other, then the languages of one family.
    jobs = []
    for a, b in itertools.combinations(sorted(members), 2):
        jobs += [(f"{a}|{b}", lang, side) for side, f in ((1, a), (-1, b)) for lang in members[f]]
    for langs in members.values():
        for a, b in itertools.combinations(langs, 2):
            jobs += [(f"{a}|{b}", a, 1), (f"{a}|{b}", b, -1)]
    if not jobs:
        return model
    rate = F.element_at(F.create_map(*[F.lit(v) for lang, n in counts.items() for v in (lang, min(1.0, per_language / n))]), F.col("lang"))
    u = F.shiftrightunsigned(F.xxhash64(F.col("key"), F.lit("fit")), 11) / F.lit(float(1 << 53))
    per_lang: dict[str, list[tuple[str, int]]] = {}
    for machine, lang, side in jobs:
        per_lang.setdefault(lang, []).append((machine, side))

    def spread(batches):
        for batch in batches:
            for i in range(0, len(batch), _BLOCK):
                texts, langs = batch.slice(i, _BLOCK).to_pydict().values()
                out = [(m, side, features(t.encode()).tobytes()) for t, lang in zip(texts, langs) for m, side in per_lang[lang]]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.int32(), pa.binary()))], ["machine", "side", "x"])

    def train(table):
        side, x = training_matrix(table)
        w, b, slope = fit_svm(x, side)
        return pa.table({"machine": table["machine"][:1], "w": pa.array([w.tobytes()], pa.binary()), "b": [b], "slope": [slope]})

    fitted = (rows.where(u < rate).select("text", "lang").mapInArrow(spread, "machine string, side int, x binary")
              .groupBy("machine").applyInArrow(train, "machine string, w binary, b double, slope double"))
    for r in fitted.collect():  # one row for each pair of families or of languages in a family
        a, b = r["machine"].split("|")
        model.machines[a, b] = (np.frombuffer(r["w"], np.float32), r["b"], r["slope"])
    return model


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """Every row of ``docs`` (text, any others) with lang_pred and score (0 to 1).

    ``und`` with score 0 for a null text, one without letters, or an empty
    model.  Input columns named like an output are replaced.
    """
    if not model.families:
        return without(docs, *OUT).withColumns({"lang_pred": F.lit("und"), "score": F.lit(0.0)})
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few weight vectors of 4,096 numbers

    @F.arrow_udf("struct<lang: string, score: double>")
    def judged(text: pa.Array) -> pa.Array:
        langs, scores = predict_batch(text, shared.value)
        return pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["lang", "score"])

    has_letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    return (without(docs, *OUT).withColumn("__lang", judged(F.col("text")))
            .withColumn("lang_pred", F.when(has_letter, F.col("__lang")["lang"]).otherwise("und"))
            .withColumn("score", F.when(has_letter, F.col("__lang")["score"]).otherwise(0.0)).drop("__lang"))


def training_rows(docs: DataFrame, held_out: int = 1) -> DataFrame:
    """Labelled rows whose crc32(doc_id as text) modulo 3 is not ``held_out``, for ``fit``.

    Rows with a null doc_id have no remainder and are not learnt from.
    """
    return (docs.where((F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3) != held_out)
            .select("text", "lang", F.col("doc_id").alias("key")))


def identify(docs: DataFrame, held_out: int = 1) -> DataFrame:
    """Fit on the labelled rows outside the held-out third of ``docs`` and predict every row.

    Adds held_out (false for a null doc_id), lang_pred and score.
    """
    model = fit(training_rows(docs, held_out))
    fold = F.coalesce((F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3) == held_out, F.lit(False))
    return predict(without(docs, "held_out"), model).withColumn("held_out", fold)
