"""Quality classifier by co-training: a text view and a metadata view teach each other, then score together."""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partura.llm.shipping import frugal, map_arrow
from partura.llm.words import chunks, mix, word_hashes

LABELLED = 4_000  # labelled documents to learn from, at most
UNLABELLED = 2_000  # documents without a label that views may teach each other, at most
ROUNDS = 3
SURE = 0.98  # how probable a label must be to one view to be taught to the other
PSEUDO_WEIGHT = 0.5
FOLDS = 3
BITS = 20  # words and their beginnings are hashed to 2 ** BITS features
STEMS = (4, 5, 6)  # bytes of a word's beginning
OFTEN = (2, 4)  # a beginning that a text has so often is a feature of its own
SHAPES = 10
META = 256

_KINDS = np.zeros(256, np.int64)  # 1 lower case, 2 upper case, 3 digit, 4 mark, 0 space and beyond ASCII
_KINDS[33:127] = 4
_KINDS[ord("a") : ord("z") + 1] = 1
_KINDS[ord("A") : ord("Z") + 1] = 2
_KINDS[ord("0") : ord("9") + 1] = 3
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[ord("A") : ord("Z") + 1] += 32
_STEP = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Rows:
    """Sparse presence features (row, column) beside dense ones."""

    n: int
    rows: np.ndarray
    columns: np.ndarray
    dense: np.ndarray

    def take(self, at: np.ndarray) -> "Rows":
        place = np.full(self.n, -1, np.int64)
        place[at] = np.arange(len(at))
        keep = place[self.rows] >= 0
        return Rows(len(at), place[self.rows[keep]].astype(np.int32), self.columns[keep], self.dense[at])

    def only(self, columns: np.ndarray) -> "Rows":
        keep = columns[self.columns]
        return Rows(self.n, self.rows[keep], self.columns[keep], self.dense)


def _keys(rows: np.ndarray, h: np.ndarray) -> np.ndarray:
    return (rows.astype(np.uint64) << np.uint64(BITS)) | (h >> np.uint64(64 - BITS))


def _stems(data: np.ndarray, rows: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """Features of how often a text's words begin alike."""
    out = []
    for size in STEMS:
        at = np.flatnonzero(ends - starts >= size)
        h = np.full(len(at), size, np.uint64)
        for j in range(size):
            h = mix(h * _STEP + _LOWER[data[starts[at] + j]])
        keys, counts = np.unique(_keys(rows[at], h), return_counts=True)
        out.append(keys)
        row, h = keys >> np.uint64(BITS), keys & np.uint64((1 << BITS) - 1)
        for k, often in enumerate(OFTEN):
            some = counts >= often
            out.append(_keys(row[some], mix(h[some] * np.uint64(8) + np.uint64(k + 1))))
    return out


def text_features(texts: pa.Array) -> Iterator[Rows]:
    """Which words a text has, how they begin, and ten measures of its shape.

    Null and empty texts have no words and shape 0.
    """
    for _, data, offsets in chunks(texts):
        n = len(offsets) - 1
        h, rows, starts, ends = word_hashes(data, offsets)
        key = np.unique(_keys(rows, h))
        distinct = np.bincount((key >> np.uint64(BITS)).astype(np.int64), minlength=n)
        key = np.concatenate([key, *_stems(data, rows, starts, ends)])
        row, column = (key >> np.uint64(BITS)).astype(np.int32), (key & np.uint64((1 << BITS) - 1)).astype(np.int32)
        size = np.diff(offsets).astype(float)
        chars = np.maximum(size, 1)
        where = np.repeat(np.arange(n), np.diff(offsets))
        kinds = np.bincount(where * 5 + _KINDS[data], minlength=5 * n)[: 5 * n].reshape(n, 5) / chars[:, None]
        lines = np.bincount(where[data == 10], minlength=n) if len(data) else np.zeros(n)
        count = np.bincount(rows, minlength=n).astype(float)
        each = np.maximum(count, 1)
        marked = (ends > starts) & (_KINDS[data[ends - 1]] == 4) if len(ends) else np.zeros(0, bool)
        tails = np.bincount(rows[marked], minlength=n) / each if len(rows) else np.zeros(n)
        shape = [*kinds[:, 1:].T * 4, size / each / 10, distinct / each, tails, lines / each * 4]
        shape += [np.log1p(count) / 8, (count == 0).astype(float)]
        yield Rows(n, row, column, np.column_stack(shape))


def meta_features(table: pa.RecordBatch | pa.Table, columns: list[str]) -> Rows:
    """Hashed values of string columns, and the logarithm of numbers. Null is a value of its own."""
    n = table.num_rows
    rows, cells, dense = [], [], []
    for k, name in enumerate(columns):
        column = table.column(name)
        if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
            values = [("\0" if v is None else "\1" + v).encode() for v in column.to_pylist()]
            known = {v: int.from_bytes(v[:6] + bytes([len(v) % 256]), "big") * 31 + sum(v) for v in set(values)}
            codes = mix(np.array([known[v] % (1 << 63) for v in values], np.uint64) + np.uint64(k))
            rows.append(np.arange(n, dtype=np.int32)), cells.append((codes % np.uint64(META)).astype(np.int32))
        else:
            v = np.array([np.nan if x is None else float(x) for x in column.to_pylist()], float)
            known_v = np.isfinite(v)
            dense += [np.where(known_v, np.sign(v) * np.log1p(np.abs(np.where(known_v, v, 0))), 0) / 8, ~known_v]
    stack = np.column_stack(dense).astype(float) if dense else np.zeros((n, 0))
    none = np.zeros(0, np.int32)
    return Rows(n, np.concatenate(rows) if rows else none, np.concatenate(cells) if cells else none, stack)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


@dataclass
class Linear:
    """Logistic regression on sparse presence and dense features."""

    sparse: np.ndarray
    dense: np.ndarray
    bias: float

    def score(self, x: Rows) -> np.ndarray:
        z = np.bincount(x.rows, weights=self.sparse[x.columns], minlength=x.n) if x.n else np.zeros(0)
        return z + x.dense @ self.dense + self.bias


def _telling(x: Rows, y: np.ndarray, weight: np.ndarray, width: int) -> np.ndarray:
    """Features of three rows at least whose shares among the two labels differ by twice the standard error."""
    n = np.bincount(x.columns, minlength=width)
    total = np.bincount(x.columns, weights=weight[x.rows], minlength=width)
    good = np.bincount(x.columns, weights=(weight * y)[x.rows], minlength=width)
    all_good, all_rest = max(float(weight @ y), 1.0), max(float(weight @ (1 - y)), 1.0)
    share = total / (all_good + all_rest)
    error = np.sqrt(np.maximum(share * (1 - share), 1e-12) * (1 / all_good + 1 / all_rest))
    return (n >= 3) & (np.abs(good / all_good - (total - good) / all_rest) >= 2 * error)


def fit(x: Rows, y: np.ndarray, weight: np.ndarray, width: int, decay: float = 1.0, steps: int = 120) -> Linear:
    """Weighted logistic regression with a penalty on squared weights, by adaptive gradient steps.

    Sparse features that tell the labels apart take part; the others get no weight.
    """
    if x.n > 60:
        x = x.only(_telling(x, y, weight, width))
    rows = x.rows
    used, local = np.unique(x.columns, return_inverse=True)
    w, v, b = np.zeros(len(used)), np.zeros(x.dense.shape[1]), 0.0
    gw, gv, gb = np.full(len(used), 1e-8), np.full(len(v), 1e-8), 1e-8
    for _ in range(steps):
        z = np.bincount(rows, weights=w[local], minlength=x.n) + x.dense @ v + b
        r = (_sigmoid(z) - y) * weight
        dw = np.bincount(local, weights=r[rows], minlength=len(used)) + decay * w
        dv = x.dense.T @ r + 0.1 * v
        db = float(r.sum())
        gw, gv, gb = gw + dw * dw, gv + dv * dv, gb + db * db
        w, v, b = w - 0.3 * dw / np.sqrt(gw), v - 0.3 * dv / np.sqrt(gv), b - 0.3 * db / gb**0.5
    sparse = np.zeros(width)
    sparse[used] = w
    return Linear(sparse, v, b)


@dataclass
class Model:
    text: Linear
    meta: Linear
    joint: np.ndarray  # weights of both views' scores and a bias, fitted on scores out of fold
    columns: list[str]

    def combine(self, zt: np.ndarray, zm: np.ndarray) -> np.ndarray:
        return _sigmoid(self.joint[0] * zt + self.joint[1] * zm + self.joint[2])


def _calibrate(zt: np.ndarray, zm: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of two scores and a bias by damped Newton steps, held near (1, 0, 0) scaled to the scores' spread."""
    spread = np.array([max(1.0, float(z.std())) if len(z) else 1.0 for z in (zt, zm)] + [1.0])
    x = np.column_stack([zt, zm, np.ones(len(y))]) / spread
    start = np.array([1.0, 0.0, 0.0])

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float(np.logaddexp(0, z).sum() - y @ z + 0.5 * ((w - start) ** 2).sum())

    w, now = start, loss(start)
    for _ in range(50):
        p = _sigmoid(x @ w)
        slope = x.T @ (p - y) + (w - start)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.eye(3), slope)
        size = 1.0
        while size > 1e-6 and loss(w - size * step) > now:
            size /= 2
        w = w - size * step if size > 1e-6 else w
        if now - loss(w) < 1e-9:
            break
        now = loss(w)
    return w / spread


def co_train(text: Rows, meta: Rows, y: np.ndarray, free_text: Rows, free_meta: Rows, columns: list[str]) -> Model:
    """Two views trained over rounds, each also on what the other is sure of, then calibrated together.

    y is 0 or 1 for the first len(y) rows of both views' labelled features. How far each view is to be
    believed comes from scores of labelled rows by classifiers that did not see them.
    """
    ones = np.ones(len(y))
    fold = np.arange(len(y)) % FOLDS
    zt, zm = np.zeros(len(y)), np.zeros(len(y))
    for k in range(FOLDS if len(y) >= 10 * FOLDS else 0):
        train, held = np.flatnonzero(fold != k), np.flatnonzero(fold == k)
        zt[held] = fit(text.take(train), y[train], ones[train], 1 << BITS).score(text.take(held))
        zm[held] = fit(meta.take(train), y[train], ones[train], META).score(meta.take(held))
    joint = _calibrate(zt, zm, y)
    # Each view's own calibration decides what it is sure of.
    own_t, own_m = _calibrate(zt, 0 * zm, y), _calibrate(0 * zt, zm, y)
    t, m = fit(text, y, ones, 1 << BITS), fit(meta, y, ones, META)
    for _ in range(ROUNDS if free_text.n else 0):
        pt = _sigmoid(own_t[0] * t.score(free_text) + own_t[2])
        pm = _sigmoid(own_m[1] * m.score(free_meta) + own_m[2])
        taught = []
        for p, x, base, old, width in ((pm, free_text, text, t, 1 << BITS), (pt, free_meta, meta, m, META)):
            sure = np.flatnonzero((p >= SURE) | (p <= 1 - SURE))
            if not len(sure):
                taught.append(old)
                continue
            more, labels = x.take(sure), (p[sure] >= 0.5).astype(float)
            both = Rows(
                base.n + more.n,
                np.concatenate([base.rows, more.rows + np.int32(base.n)]),
                np.concatenate([base.columns, more.columns]),
                np.vstack([base.dense, more.dense]),
            )
            weight = np.concatenate([ones, np.full(more.n, PSEUDO_WEIGHT)])
            taught.append(fit(both, np.concatenate([y, labels]), weight, width))
        t, m = taught
    return Model(t, m, joint, columns)


def _described(names: list[str]):
    """Step that puts lists of features in place of texts, where the texts are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [batch.column(batch.schema.get_field_index(n)) for n in names]
            done = 0
            for r in text_features(batch.column(batch.schema.get_field_index("_text"))):
                order = np.argsort(r.rows, kind="stable")
                ends = np.cumsum([0, *np.bincount(r.rows, minlength=r.n)]).astype(np.int32)
                features = pa.ListArray.from_arrays(pa.array(ends), pa.array(r.columns[order]))
                at = np.arange(0, (r.n + 1) * SHAPES, SHAPES, dtype=np.int32)
                shape = pa.ListArray.from_arrays(pa.array(at), pa.array(r.dense.ravel()))
                part = [c.slice(done, r.n) for c in kept]
                yield pa.RecordBatch.from_arrays([*part, features, shape], [*names, "_features", "_shape"])
                done += r.n

    return run


def _learned(columns: list[str]):
    """Step that trains on all rows it is given and returns the pickled model, or nothing if there is nothing to learn."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given = list(batches)
        if not sum(b.num_rows for b in given):
            return
        table = pa.Table.from_batches(given)
        ids = table.column("_id").to_numpy().view(np.uint64)
        table = table.take(pa.array(np.argsort(mix(ids), kind="stable"))).combine_chunks()
        features = table.column("_features").combine_chunks()
        column, sizes = features.flatten().to_numpy(), features.value_lengths().to_numpy()
        text = Rows(
            table.num_rows,
            np.repeat(np.arange(table.num_rows, dtype=np.int32), sizes),
            column,
            table.column("_shape").combine_chunks().flatten().to_numpy().reshape(-1, SHAPES),
        )
        if text.n > 60:  # features of one or two texts teach nothing and are most of them
            text = text.only(np.bincount(column, minlength=1 << BITS) >= 3)
        y = table.column("_clean").to_pandas().to_numpy(float)
        known, free = np.flatnonzero(~np.isnan(y)), np.flatnonzero(np.isnan(y))
        if not len(known) or y[known].min() == y[known].max():
            return
        meta = meta_features(table.rename_columns({f"_m{k}": c for k, c in enumerate(columns)}), columns)
        model = co_train(text.take(known), meta.take(known), y[known], text.take(free), meta.take(free), columns)
        del given, table, features, column, text, meta
        pa.default_memory_pool().release_unused()  # this worker goes on to score beside others
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])

    return run


def train(docs: DataFrame, labels: DataFrame, metadata: list[str]) -> Model | None:
    """Learn from the labelled `docs` which are clean: quality 1 and not toxic.

    `labels` (doc_id, quality, toxic): a null mark counts as quality 1 or not toxic; of a doc_id labelled more than
    once the worst marks hold. At most LABELLED labelled and UNLABELLED other documents, those with the least hash
    of their doc_id, are learnt from; their features, not their texts, meet in one task, and only the model comes
    to the driver. None if the labels are empty or all the same.
    """
    marks = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("_id"))
    clean = (F.min(F.coalesce("quality", F.lit(1))) == 1) & (F.max(F.coalesce("toxic", F.lit(0))) == 0)
    marks = marks.agg(clean.cast("double").alias("_clean"))
    views = [F.col(c).alias(f"_m{k}") for k, c in enumerate(metadata)]
    own = docs.select(F.col("doc_id").cast("long").alias("_id"), *views, F.col("text").cast("string").alias("_text"))
    order = F.xxhash64("_id", F.lit(3))
    ids = own.select("_id").where("_id is not null").join(marks, "_id", "left")
    some = ids.where("_clean is not null").orderBy(order).limit(LABELLED)
    others = ids.where("_clean is null").orderBy(order).limit(UNLABELLED)
    picked = F.broadcast(some.unionByName(others).dropDuplicates(["_id"]))
    names = ["_id", "_clean", *(f"_m{k}" for k in range(len(metadata)))]
    examples = own.join(picked, "_id").select(*names, "_text")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in examples.select(*names).schema.fields)
    described = map_arrow(examples, frugal(_described(names)), f"{kinds}, _features array<int>, _shape array<double>")
    models = map_arrow(described.repartition(1), frugal(_learned(metadata)), "model binary").collect()
    return pickle.loads(models[0].model) if models else None


def _score(shared, names: list[str], text_at: int):
    """Step that adds scores to each row; what it holds at a time beside a batch is one run of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        places = [names.index(c) for c in model.columns]
        for batch in batches:
            done = 0
            for r in text_features(batch.column(text_at)):
                part = batch.slice(done, r.n)
                views = pa.RecordBatch.from_arrays([part.column(k) for k in places], model.columns)
                zt, zm = model.text.score(r), model.meta.score(meta_features(views, model.columns))
                scores = [pa.array(_sigmoid(zt)), pa.array(_sigmoid(zm)), pa.array(model.combine(zt, zm))]
                yield pa.RecordBatch.from_arrays(part.columns[: len(names)] + scores, [*names, "p_text", "p_meta", "score"])
                done += r.n

    return run


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """`docs` with p_text, p_meta and score, the probability that a document is clean.

    Without a model nothing is known against any document: all scores are 1. Columns of these names are replaced.
    """
    made = ["p_text", "p_meta", "score"]
    base = docs.drop(*made)
    if model is None:
        return base.select("*", *[F.lit(1.0).alias(c) for c in made])
    names, given = base.columns, base
    text_at = names.index("text")
    if base.schema["text"].dataType.simpleString() != "string":
        text_at = len(names)
        given = base.select("*", F.col("text").cast("string").alias("_" * max(map(len, names)) + "text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema.fields)
    schema = f"{kinds}, p_text double, p_meta double, score double"
    return map_arrow(given, frugal(_score(shared, names, text_at)), schema)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """`docs` with p_text, p_meta, score and `clean` (score >= threshold), for every row.

    The metadata view takes source, lang and n_chars, as far as `docs` has them. Null and empty texts are scored by what they
    lack. Repeated rows get the same scores.
    """
    metadata = [c for c in ("source", "lang", "n_chars") if c in docs.columns]
    scored = score(docs.drop("clean"), train(docs, labels, metadata))
    return scored.withColumn("clean", F.col("score") >= threshold)
