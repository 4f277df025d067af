"""Quality classifier: ordinal cumulative-link regression on graded ratings over hashed text.

The model is one latent score s(x) = sum of weights of the hashed features a
text has, shared by all grades, and ordered thresholds t_1 < t_2 < ...:
P(grade >= j) = sigmoid(s(x) - t_j).  From the tail probabilities follow the
expected grade (their sum) and the selection: a document is kept when
P(grade >= ``KEEP_GRADE``) >= ``KEEP_PROBABILITY``.

Features (presence, hashed to ``DIMENSIONS``): lower-cased words, their first
four to seven bytes, and document shape: log-scaled shares of
words by form (capitals, digits, symbols, repeated words) and size.

Grades come from ``labels``: toxic 0, low quality 1, good 2.  The fit uses a
bounded sample, the ``TRAIN_ROWS`` labelled documents of smallest hash, of each
all its features; its hashed rows (integers) meet in one task, where AdaGrad
runs for ``EPOCHS`` passes.  The weights (``DIMENSIONS`` floats) go back to the
driver and to the workers with the scoring function.

Edge cases: null or empty texts have the shape features of an empty document;
labels without document, null grades and repeated labels (the lowest grade
counts) are allowed; without any labelled row, or with one grade only, nothing
is known and every document is kept with probability 1; repeated rows score
alike; a probability of exactly the threshold keeps; very long texts are scored
whole, in a chunk of their own; an empty table gives no rows; extra columns pass
through.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import h
from .common import packed, stored
from .textvec import LOWER, chunks, hash_runs, mix64, segments, words

DIMENSIONS = 1 << 18
GRADES = 3
#: Bound of the training sample.
TRAIN_ROWS = 12_000
EPOCHS = 10
RATE = 0.1
#: Shrinkage per row; without it the many faint words of a long text outweigh its few telling ones.
L1 = 1e-3
#: Weight decay per row.  Features of fewer training documents than MIN_DOCUMENTS (or a hundredth of them) have no weight.
L2 = 3e-3
MIN_DOCUMENTS = 20
PREFIXES = (4, 5, 6, 7)
KEEP_GRADE = 2
KEEP_PROBABILITY = 0.5
SEED = 6


def _forms(w) -> np.ndarray:
    """Form bits of each word: 1 capitals only, 2 has a digit, 4 symbol at its end, 8 symbol only, 16 over 20 bytes."""
    kind = np.zeros(256, np.int64)
    kind[65:91] = 1
    kind[97:123] = 2
    kind[128:] = 2
    kind[48:58] = 4
    sym = kind == 0
    kind[sym] = 8
    for c in b".,;:?'\"-()":            # ordinary punctuation is no symbol
        kind[c] = 0
    total = np.concatenate(([0], np.cumsum(kind[w.data] == 1))), np.concatenate(([0], np.cumsum(kind[w.data] == 2)))
    digit = np.concatenate(([0], np.cumsum(kind[w.data] == 4)))
    caps = total[0][w.end] - total[0][w.start]
    small = total[1][w.end] - total[1][w.start]
    form = ((caps > 1) & (small == 0)).astype(np.int64)
    form |= (digit[w.end] > digit[w.start]).astype(np.int64) << 1
    last = kind[w.data[w.end - 1]] == 8
    form |= last.astype(np.int64) << 2
    form |= (last & (caps + small == 0)).astype(np.int64) << 3
    form |= (w.end - w.start > 20).astype(np.int64) << 4
    return form


def features(texts: pa.Array, dims: int = DIMENSIONS, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(text index, feature index) pairs, distinct and sorted by text; only ``wanted`` features if given."""
    rows = len(texts)
    w = words(texts, lower=False)
    n = np.bincount(w.doc, minlength=rows)
    docs_at, found = [], []
    shift = np.uint64(64 - (dims.bit_length() - 1))

    def add(doc, key, tag):
        idx = (mix64(key.astype(np.uint64) ^ mix64(np.array([tag], np.uint64))[0]) >> shift).astype(np.int64)
        if wanted is not None:
            use = wanted[idx]
            doc, idx = doc[use], idx[use]
        docs_at.append(doc)
        found.append(idx)
    add(np.arange(rows), np.floor(np.log2(n + 1)), 5)
    if len(w.doc):
        low = LOWER[w.data]
        lower = hash_runs(low, w.start, w.end)
        order = np.lexsort((lower, w.doc))
        new = np.ones(len(order), bool)
        new[1:] = (np.diff(w.doc[order]) != 0) | (np.diff(lower[order]) != 0)
        one = order[new]                                # each distinct word of a text once
        doc, start, size = w.doc[one], w.start[one], w.end[one] - w.start[one]
        add(doc, lower[one], 1)
        acc = np.zeros(len(one), np.uint64)
        for k in range(1, max(PREFIXES) + 1):
            acc = mix64(acc + np.uint64(k)) + low[np.minimum(start + k - 1, len(low) - 1)]
            if k in PREFIXES:
                long = size >= k
                add(doc[long], acc[long], 16 + k)
        first, docs = segments(w.doc)
        form = _forms(w)
        same = np.concatenate(([False], (np.diff(w.doc) == 0) & (np.diff(lower) == 0)))
        shares = [np.add.reduceat((form >> i & 1), first) / n[docs] for i in range(5)]
        shares += [1 - np.bincount(doc, minlength=rows)[docs] / n[docs], np.add.reduceat(same, first) / n[docs]]
        for i, share in enumerate(shares):              # bins: 0, then powers of two up to 1
            bins = np.where(share > 0, 10 + np.maximum(np.floor(np.log2(np.maximum(share, 1e-6))), -9), 0)
            add(docs, bins + 64 * i, 4)
    key = np.sort(np.concatenate(docs_at).astype(np.int64) * dims + np.concatenate(found))
    key = key[np.concatenate(([True], np.diff(key) != 0))] if len(key) else key
    return key // dims, key % dims


class Model(NamedTuple):
    weights: np.ndarray      # float32, one per hashed feature
    thresholds: np.ndarray   # rising, grades - 1


def tails(score: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
    """(rows, grades - 1): P(grade >= 1), P(grade >= 2), ..."""
    return 1 / (1 + np.exp(-np.clip(score[:, None] - thresholds[None, :], -40, 40)))


def fit(rows: list[np.ndarray], grade: np.ndarray, grades: int = GRADES, dims: int = DIMENSIONS,
        epochs: int = EPOCHS, rate: float = RATE, l1: float = L1, l2: float = L2, seed: int = SEED) -> Model | None:
    """AdaGrad on the cumulative-link log-likelihood; None if there is nothing to tell apart."""
    if len(np.unique(grade)) < 2:
        return None
    often = np.zeros(dims, np.int32)
    for r in rows:
        often[r] += 1                                    # a row names a feature once
    often = often >= max(2, min(MIN_DOCUMENTS, len(rows) // 100))
    rows = [r[often[r]] for r in rows]
    w, g2 = np.zeros(dims), np.full(dims, 1e-3)
    t, t2 = np.linspace(-1, 1, grades - 1), np.full(grades - 1, 1e-3)
    rng = np.random.default_rng(seed)
    size = np.array([len(r) for r in rows])
    mean_w, mean_t, half = np.zeros(dims), np.zeros(grades - 1), epochs // 2
    for epoch in range(epochs):
        order = rng.permutation(len(rows))
        for lo in range(0, len(order), 64):
            ids = order[lo:lo + 64]
            idx = np.concatenate([rows[i] for i in ids])
            doc = np.repeat(np.arange(len(ids)), size[ids])
            s = np.bincount(doc, w[idx], minlength=len(ids))
            p = np.column_stack([np.ones(len(ids)), tails(s, t), np.zeros(len(ids))])
            y, each = grade[ids], np.arange(len(ids))
            up, down = p[each, y], p[each, y + 1]        # P(grade >= y), P(grade > y)
            like = np.maximum(up - down, 1e-9)
            gt = np.zeros(grades - 1)                    # of the loss -log(up - down)
            np.add.at(gt, np.maximum(y - 1, 0), np.where(y > 0, up * (1 - up) / like, 0))
            np.add.at(gt, np.minimum(y, grades - 2), np.where(y < grades - 1, -down * (1 - down) / like, 0))
            hot = np.unique(idx)
            gh = np.bincount(idx, (up + down - 1)[doc], minlength=dims)[hot] + l2 * len(ids) * w[hot]
            g2[hot] += gh * gh
            step = rate / np.sqrt(g2[hot])
            moved = w[hot] - step * gh
            w[hot] = np.sign(moved) * np.maximum(np.abs(moved) - step * l1 * len(ids), 0)
            t2 += gt * gt
            t = np.sort(t - rate * gt / np.sqrt(t2))
        if epoch >= half:                                # the average of the later passes is steadier than the last
            mean_w += w / (epochs - half)
            mean_t += t / (epochs - half)
    return Model(mean_w.astype(np.float32), mean_t)


def grades(labels: DataFrame) -> DataFrame:
    """(doc_id, grade): toxic 0, low quality 1, good 2; rows without a usable label are left out."""
    toxic, good = F.coalesce("toxic", F.lit(0)) != 0, F.col("quality")
    grade = F.when(toxic, 0).when(good == 0, 1).when(good > 0, 2)
    return (labels.select(F.col("doc_id").cast("long").alias("_lid"), grade.alias("grade"))
            .where("grade IS NOT NULL AND _lid IS NOT NULL").groupBy("_lid").agg(F.min("grade").alias("grade")))


def train(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, id_col: str = "doc_id",
          text_col: str = "text", seed: int = SEED) -> Model | None:
    """Fit on the ``train_rows`` labelled documents whose id hashes lowest (the documented bound)."""
    chosen = stored(grades(labels).withColumn("_h", h(F.lit("train"), F.col("_lid"), seed=seed))
                    .orderBy("_h", "_lid").limit(train_rows).drop("_h"), "quality-sample")
    rows = (docs.select(F.col(id_col).cast("long").alias("_lid"), F.col(text_col).alias("text"))
            .join(F.broadcast(chosen), "_lid").select("_lid", "grade", "text"))

    def run(batches):
        for b in chunks(batches):
            doc, idx = features(b.column(2))
            ends = np.searchsorted(doc, np.arange(b.num_rows + 1)).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(idx.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), lists], names=["id", "grade", "idx"])

    def fit_all(batches):
        lists, grade = [], []
        for b in batches:
            idx = b.column("idx")
            ends, flat = idx.offsets.to_numpy(), idx.values.to_numpy()
            lists += [flat[x:y] for x, y in zip(ends, ends[1:])]
            grade.append(b.column("grade").to_numpy().astype(np.int64))
        model = fit(lists, np.concatenate(grade)) if lists else None
        if model is not None:
            yield pa.RecordBatch.from_arrays([pa.array([model.weights.tobytes()], pa.binary()),
                                              pa.array([model.thresholds.tobytes()], pa.binary())], names=["w", "t"])
    # one task holds the sample: at most train_rows documents, whatever the size of the corpus
    hashed = rows.mapInArrow(run, "id long, grade int, idx array<int>").repartition(1).sortWithinPartitions("id", "grade")
    got = hashed.mapInArrow(fit_all, "w binary, t binary").collect()
    return Model(np.frombuffer(got[0].w, np.float32), np.frombuffer(got[0].t)) if got else None


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text",
          keep_grade: int = KEEP_GRADE, keep_probability: float = KEEP_PROBABILITY,
          carry: bool = False) -> DataFrame:
    """(doc_id, score, expected_grade, p_keep, kept), with all columns in ``_row`` if ``carry``."""
    ident, text = F.col(id_col).cast("long"), F.col(text_col)
    rows = packed(docs, doc_id=ident, text=text) if carry else docs.select(ident.alias("doc_id"), text.alias("text"))
    wanted = None if model is None else model.weights != 0

    def run(batches):
        for b in chunks(batches):
            if model is None:
                s, top, p = np.zeros(b.num_rows), np.full(b.num_rows, GRADES - 1.0), np.ones(b.num_rows)
            else:
                doc, idx = features(b.column(b.num_columns - 1), wanted=wanted)
                s = np.bincount(doc, model.weights[idx].astype(float), minlength=b.num_rows)
                tail = tails(s, model.thresholds)
                top, p = tail.sum(axis=1), tail[:, keep_grade - 1]
            out = [b.column(b.num_columns - 2), pa.array(s), pa.array(top), pa.array(p), pa.array(p >= keep_probability)]
            names = ["doc_id", "score", "expected_grade", "p_keep", "kept"]
            if carry:
                out, names = [b.column(0), *out], ["_row", *names]
            yield pa.RecordBatch.from_arrays(out, names=names)
    kinds = "doc_id long, score double, expected_grade double, p_keep double, kept boolean"
    if carry:
        from pyspark.sql.types import StructType
        schema = StructType([rows.schema["_row"], *StructType.fromDDL(kinds).fields])
        return rows.mapInArrow(run, schema)
    return rows.mapInArrow(run, kinds)
