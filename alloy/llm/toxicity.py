"""Toxicity (operator 5): a classifier chain of hashed linear models.

The label columns are the categories, predicted one after the other; the model
of each also takes the probabilities of the categories before it. While it is
trained, those are out-of-fold predictions (each document's come from models that
did not see it), so a later model meets them as uncertain as they will be when
documents without labels are scored.

The models are fitted on at most ``max_labelled`` labelled documents, the first
by a hash of doc_id; every fit (folds + 1 for each category) is one task over
that bounded sample. All documents are scored, whole, without a shuffle.

Defined cases: a label row with a null is not used; several rows of one doc_id
count as their greatest values, and of several documents with one labelled
doc_id one is used; without labels, or with one class only, no document is
toxic; null or empty text has no features and gets the models' bias; a null
doc_id is scored as well; equal rows are scored each for itself; an empty table
gives no rows; extra columns are ignored (``drop_toxic`` keeps them).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from alloy.llm import linear
from alloy.llm.common import id_text, slices, written

CATEGORIES = ("quality", "toxic")
MAX_LABELLED = 12_000


def sample_features(docs: DataFrame, chosen: DataFrame, shapes: bool = False) -> DataFrame:
    """``chosen`` (doc_id and more; few enough rows to broadcast) with the cells
    of its documents' texts, one row for each doc_id."""
    keep = [c for c in chosen.columns if c != "doc_id"]
    joined = id_text(docs).join(F.broadcast(chosen), "doc_id").select("doc_id", "text", *keep)

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = linear.Cells(shapes)
        for batch in batches:
            for part in slices(batch):
                found = pa.array([known.of(t).astype("<u4").tobytes() for t in part.column(1).to_pylist()], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), found, *part.columns[2:]], names=["doc_id", "cells", *keep])

    types = dict(chosen.dtypes)
    schema = ", ".join(["doc_id long", "cells binary", *[f"{c} {types[c]}" for c in keep]])
    one = joined.mapInArrow(cells, schema).groupBy("doc_id").agg(F.min(F.struct("cells", *keep)).alias("row"))
    return written(one.select("doc_id", "row.*"), "label-features")


def _fitter(i: int, folds: int):
    """One fit of category ``i``: a model without the fold of the group's key and
    its predictions for that fold, or, for key ``folds``, the final model."""
    before = [f"p{j}" for j in range(i)]

    def fit_one(key, group):
        import pandas as pd

        left_out = group["fold"] == key[0]  # none for the last fit
        train = group[~left_out].sort_values("doc_id")
        w = linear.fit([np.frombuffer(c, "<u4").astype(np.int64) for c in train["cells"]],
                       train[f"y{i}"].to_numpy(float), train[before].to_numpy(float).reshape(len(train), i))
        if key[0] == folds:
            return pd.DataFrame({"doc_id": [0], "p": [0.0], "weights": [w.tobytes()]})
        held = group[left_out]
        p = [float(linear.sigmoid(linear.margin(w, np.frombuffer(c, "<u4").astype(np.int64), x)))
             for c, x in zip(held["cells"], held[before].to_numpy(float).reshape(len(held), i))]
        return pd.DataFrame({"doc_id": held["doc_id"], "p": p, "weights": None})

    return fit_one


def fit_chain(docs: DataFrame, labels: DataFrame, categories: tuple[str, ...] = CATEGORIES, folds: int = 3,
              max_labelled: int = MAX_LABELLED) -> list[np.ndarray]:
    """The weights of each category's model, in order."""
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"),
                           *[(F.col(c) > 0).cast("int").alias(f"y{i}") for i, c in enumerate(categories)]).dropna()
    ys = [f"y{i}" for i in range(len(categories))]
    chosen = usable.groupBy("doc_id").agg(*[F.max(y).alias(y) for y in ys]).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    rows = sample_features(docs, chosen).withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(folds)).cast("int"))
    weights: list[np.ndarray] = []
    for i in range(len(categories)):
        before = [f"p{j}" for j in range(i)]

        fits = rows.withColumn("fit", F.explode(F.sequence(F.lit(0), F.lit(folds))))
        fits = fits.select("fit", "doc_id", "cells", "fold", ys[i], *before)
        made = written(fits.groupBy("fit").applyInPandas(_fitter(i, folds), "doc_id long, p double, weights binary"), f"chain-{i}")
        final = made.filter(F.col("weights").isNotNull()).select("weights").head()  # one row of fixed size
        weights.append(np.frombuffer(final.weights) if final else linear.fit([], np.zeros(0), np.zeros((0, i))))
        if i + 1 < len(categories):
            rows = rows.join(made.filter(F.col("weights").isNull()).select("doc_id", F.col("p").alias(f"p{i}")), "doc_id")
    return weights


def probabilities(text: str, known: linear.Cells, weights: list[np.ndarray]) -> list[float]:
    cells = known.of(text)
    p: list[float] = []
    for w in weights:
        p.append(float(linear.sigmoid(linear.margin(w, cells, p))))
    return p


def score(docs: DataFrame, weights: list[np.ndarray], categories: tuple[str, ...] = CATEGORIES, threshold: float = 0.5) -> DataFrame:
    """(doc_id, p_<category>..., toxic): the last category decides."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = linear.Cells(False)
        for batch in batches:
            for part in slices(batch):
                p = [probabilities(t, known, weights) for t in part.column(1).to_pylist()]
                columns = [pa.array([x[i] for x in p], pa.float64()) for i in range(len(weights))]
                toxic = pa.array([x[-1] > threshold for x in p], pa.bool_())
                yield pa.RecordBatch.from_arrays([part.column(0), *columns, toxic], names=names)

    names = ["doc_id", *[f"p_{c}" for c in categories], "toxic"]
    schema = ", ".join(["doc_id long", *[f"p_{c} double" for c in categories], "toxic boolean"])
    return id_text(docs).mapInArrow(scored, schema)


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``docs`` (all its columns) without the documents that the chain rejects."""
    weights = fit_chain(docs, labels)
    at = docs.columns.index("text")

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = linear.Cells(False)
        for batch in batches:
            for part in slices(batch, at):
                keep = [probabilities(t or "", known, weights)[-1] <= threshold for t in part.column(at).to_pylist()]
                yield part.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(clean, docs.schema)
