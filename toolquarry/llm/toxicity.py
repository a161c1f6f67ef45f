"""Toxicity by a counterfactual-regularised classifier.

A logistic model over the words of a text and their beginnings. For every labelled text that
mentions an identity group there is a counterfactual with the terms swapped within their
group; the square of the change of the score between both is penalised, so a neutral mention
moves no score. Weights are sparse (L1) and the model is a short table.

The fit takes at most ``max_labelled`` labelled ids, those of the smallest hash; scores cover
every whole text.
"""

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .hashing import separators, span_hashes, words
from .work import stored, text_chunks, work_folder

# Identity terms; a swap stays within its group.
IDENTITY_GROUPS = (
    ("muslim", "christian", "jewish", "hindu", "buddhist", "catholic", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "catholics", "atheists"),
    ("gay", "straight", "lesbian", "bisexual", "transgender", "queer"),
    ("black", "white", "asian", "latino", "african", "european", "arab"),
    ("man", "woman"),
    ("men", "women"),
    ("immigrant", "refugee", "citizen", "foreigner"),
    ("blind", "deaf", "disabled"),
    ("muslimisch", "christlich", "jüdisch", "katholisch"),
    ("frau", "mann"),
    ("frauen", "männer"),
    ("schwul", "lesbisch", "hetero"),
    ("musulman", "chrétien", "juif", "catholique"),
    ("femme", "homme"),
    ("femmes", "hommes"),
    ("musulmán", "cristiano", "judío", "católico"),
    ("mujer", "hombre"),
    ("mujeres", "hombres"),
)
# Bytes between words, after A-Z became a-z; all bytes beyond ASCII belong to words.
BETWEEN_WORDS = ((0x00, 0x60), (0x7B, 0x7F))
BEGINNINGS = (4, 5, 6)  # bytes
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Model(NamedTuple):
    """Sorted feature hashes, their weights, and the constant term."""

    features: np.ndarray
    weights: np.ndarray
    bias: float


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Features of each word, one column per kind; a beginning is not the word itself."""
    values = data.astype(np.uint64) + np.uint64(1)
    columns = [span_hashes(values, starts, ends)]
    for size in BEGINNINGS:
        cut = np.minimum(starts + size, ends)
        columns.append(span_hashes(values, starts, cut) ^ np.uint64(size))
    return np.stack(columns, axis=1)


def _word_features(word: str) -> np.ndarray:
    data = np.frombuffer(word.encode(), np.uint8)
    return _hashes(data, np.array([0]), np.array([len(data)]))[0]


def text_features(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(row, feature)`` pairs, each once, sorted by row, for chunks of the column."""
    table = separators(*BETWEEN_WORDS)
    for first, data, offsets in text_chunks(texts):
        starts, ends, rows = words(_LOWER[data], offsets, table)
        feature = _hashes(_LOWER[data], starts, ends)
        row = np.repeat(np.arange(len(rows) - 1) + first, np.diff(rows) * feature.shape[1])
        yield row, feature.ravel()


def _labelled_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``toxic, features, swapped``: distinct features of a text and of its counterfactual."""
    swap = {}
    for group in IDENTITY_GROUPS:
        for i, term in enumerate(group):
            old, new = _word_features(term), _word_features(group[(i + 1) % len(group)])
            swap[int(old[0])] = dict(zip(old.tolist(), new.tolist(), strict=True))
    terms = np.array(sorted(swap), np.uint64)
    kinds = 1 + len(BEGINNINGS)
    for batch in batches:
        plain: list = [np.zeros(0, np.uint64)] * batch.num_rows
        other: list = [None] * batch.num_rows
        for row, feature in text_features(batch.column(1)):
            for r, part in zip(*_runs(row, feature), strict=True):
                plain[r] = np.unique(part)
                mentions = np.flatnonzero(np.isin(part[::kinds], terms))
                if len(mentions):
                    changed = part.copy()
                    for m in mentions.tolist():
                        to = swap[int(part[m * kinds])]
                        changed[m * kinds : (m + 1) * kinds] = list(to.values())
                    other[r] = np.unique(changed).view(np.int64)
        lists = pa.list_(pa.int64())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0).cast(pa.int32()),
                pa.array([p.view(np.int64) for p in plain], lists),
                pa.array(other, lists),
            ],
            ["toxic", "features", "swapped"],
        )


def _runs(row: np.ndarray, feature: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    if not len(row):
        return row, []
    cuts = np.flatnonzero(np.diff(row)) + 1
    return row[np.concatenate(([0], cuts))], np.split(feature, cuts)


def _places(table: np.ndarray, features: np.ndarray) -> np.ndarray:
    """Place of each feature in a sorted table, -1 for others; in steps, to stay small."""
    out = np.full(len(features), -1, np.int32)
    for a in range(0, len(features) if len(table) else 0, 1 << 20):
        part = features[a : a + (1 << 20)]
        at = np.minimum(np.searchsorted(table, part), len(table) - 1)
        out[a : a + len(part)] = np.where(table[at] == part, at, -1)
    return out


def fit_rows(
    toxic: np.ndarray,
    flat: np.ndarray,
    sizes: np.ndarray,
    swapped: dict[int, np.ndarray],
    swap_penalty: float,
    l1: float,
    rounds: int = 300,
) -> Model:
    """Fit the model: accelerated proximal gradient steps on log loss, swap penalty and L1.

    ``flat`` holds the features of all rows, ``sizes`` of each; ``swapped`` those of the
    counterfactuals of some rows.
    """
    n = len(toxic)
    rate = float(np.clip((toxic.sum() + 0.5) / (n + 1.0), 1e-4, 0.9999)) if n else 0.01
    bias = float(np.log(rate / (1 - rate)))
    none = Model(np.zeros(0, np.uint64), np.zeros(0), bias)
    if n == 0 or toxic.min() == toxic.max():
        return none
    # Features that lean to one label beyond chance are screened in; the fit decides on them.
    # Features of one text are dropped first: they are most, and tell nothing.
    row = np.repeat(np.arange(n, dtype=np.int32), sizes)
    ends = np.cumsum(sizes)
    ordered = np.sort(flat)
    again = ordered[1:] == ordered[:-1]
    feature = ordered[1:][again & ~np.append(again[1:], False)]
    del ordered, again
    column = _places(feature, flat)
    row, column = row[column >= 0], column[column >= 0]
    seen = np.bincount(column, minlength=len(feature))
    bad = np.bincount(column, weights=toxic[row], minlength=len(feature))
    lean = (bad - rate * seen) / np.sqrt(np.maximum(seen * rate * (1 - rate), 1e-12))
    chosen = np.flatnonzero(np.abs(lean) >= 2.0)
    if not len(chosen):
        return none
    dense = np.full(len(feature), -1, np.int32)
    dense[chosen] = np.arange(len(chosen))
    column = dense[column]
    row, column = row[column >= 0], column[column >= 0]
    kept = feature[chosen]

    def columns(features: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(kept, features), len(kept) - 1)
        return at[kept[at] == features]

    pairs = sorted(swapped)
    d_row, d_col, d_val = [], [], []
    for k, i in enumerate(pairs):
        for features, sign in ((flat[ends[i] - sizes[i] : ends[i]], 1.0), (swapped[i], -1.0)):
            c = columns(features)
            d_row.append(np.full(len(c), k))
            d_col.append(c)
            d_val.append(np.full(len(c), sign))
    if pairs:
        d_row, d_col, d_val = map(np.concatenate, (d_row, d_col, d_val))
    p = len(kept)
    times = lambda w: np.bincount(row, weights=w[column], minlength=n)

    def slope(w: np.ndarray, b: float) -> tuple[np.ndarray, float]:
        miss = 1 / (1 + np.exp(-np.clip(times(w) + b, -30, 30))) - toxic
        g = np.bincount(column, weights=miss[row], minlength=p) / n
        if pairs:
            change = np.bincount(d_row, weights=d_val * w[d_col], minlength=len(pairs))
            g += 2 * swap_penalty / len(pairs) * np.bincount(d_col, weights=d_val * change[d_row], minlength=p)
        return g, float(miss.mean())

    # Step length from the curvature along a few power iterations.
    v = np.ones(p) / np.sqrt(p)
    bend = 1.0
    for _ in range(20):
        u = np.bincount(column, weights=times(v)[row], minlength=p) / (4 * n)
        if pairs:
            change = np.bincount(d_row, weights=d_val * v[d_col], minlength=len(pairs))
            u += 2 * swap_penalty / len(pairs) * np.bincount(d_col, weights=d_val * change[d_row], minlength=p)
        bend = max(float(np.linalg.norm(u)), 1e-9)
        v = u / bend
    step = 1 / (1.2 * bend + 0.25)
    w, b = np.zeros(p), bias
    y_w, y_b, t = w, b, 1.0
    for _ in range(rounds):
        g, g_b = slope(y_w, y_b)
        new = y_w - step * g
        new = np.sign(new) * np.maximum(np.abs(new) - step * l1, 0)
        new_b = y_b - step * g_b
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y_w, y_b = new + (t - 1) / t_next * (new - w), new_b + (t - 1) / t_next * (new_b - b)
        w, b, t = new, new_b, t_next
    used = np.flatnonzero(w)
    return Model(kept[used], w[used], float(b))


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    max_labelled: int = 8_000,
    swap_penalty: float = 1.0,
    l1: float = 0.0005,
    folder: str | None = None,
) -> Model:
    """Fit on the texts of ``docs`` (``doc_id, text``) that ``labels`` (``doc_id, toxic``) names.

    At most ``max_labelled`` ids are used, those of the smallest hash; that bounds what is
    broadcast to find their texts, and the one task that fits. Labels that are null are left
    out, and an id with several is toxic if one of them says so. Null texts count as empty.
    Without rows of both labels the model is its constant term.
    """
    spark = docs.sparkSession
    folder = folder or work_folder(spark)
    chosen = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id")
    chosen = chosen.agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("toxic", "text").repartition(32)
    rows = stored(
        sample.mapInArrow(_labelled_features, "toxic int, features array<long>, swapped array<long>"),
        folder,
        "labelled",
    )

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        toxic, flat, sizes, swapped = [], [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], {}
        for batch in batches:
            for i in np.flatnonzero(batch.column(2).is_valid().to_numpy(zero_copy_only=False)).tolist():
                found = batch.column(2)[i].values.to_numpy(zero_copy_only=False)
                swapped[len(toxic) + i] = found.astype(np.int64).view(np.uint64)
            toxic += batch.column(0).to_pylist()
            flat.append(batch.column(1).flatten().to_numpy(zero_copy_only=False).view(np.uint64))
            sizes.append(np.diff(batch.column(1).offsets.to_numpy()))
        flat = flat[1] if len(flat) == 2 else np.concatenate(flat)
        model = fit_rows(np.array(toxic, float), flat, np.concatenate(sizes), swapped, swap_penalty, l1)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.append(model.features.view(np.int64), 0)),
                pa.array(np.append(model.weights, model.bias)),
                pa.array([False] * len(model.weights) + [True]),
            ],
            ["feature", "weight", "is_bias"],
        )

    fitted = rows.coalesce(1).mapInArrow(fit, "feature long, weight double, is_bias boolean").collect()
    terms = sorted((np.int64(r["feature"]).astype(np.uint64), r["weight"]) for r in fitted if not r["is_bias"])
    bias = next((r["weight"] for r in fitted if r["is_bias"]), float(np.log(0.01 / 0.99)))
    return Model(
        np.array([f for f, _ in terms], np.uint64), np.array([w for _, w in terms], float), float(bias)
    )


def score_texts(texts: pa.Array, model: Model) -> np.ndarray:
    total = np.full(len(texts), model.bias)
    if len(model.features):
        for row, feature in text_features(texts):
            at = np.minimum(np.searchsorted(model.features, feature), len(model.features) - 1)
            hit = model.features[at] == feature
            # a feature counts once in a text
            once = np.unique(row[hit] * len(model.features) + at[hit])
            total += np.bincount(
                once // len(model.features), weights=model.weights[once % len(model.features)], minlength=len(total)
            )
    return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def score_toxicity(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``toxicity``, 0 to 1; the higher, the likelier a text is toxic.

    Whole texts are scored, from nothing but the text; null and empty texts get the score of
    the constant term. Rows stay as they are, and so do other columns (a column ``toxicity``
    is replaced).
    """

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(score_texts(texts, model))

    return docs.withColumn("toxicity", score.asNondeterministic()(F.col(text)))
