"""Toxicity by a bidirectional gated recurrent network with attention pooling, in numpy.

A word enters as the sum of two looked-up halves: a vector of its own, for words of the training
texts, and the mean vector of its hashed character trigrams. A GRU reads each window of ``WINDOW``
words in both directions, attention pools its states, and a linear unit gives the window's logit.
Windows overlap by half and cover the whole text; a text scores as its worst window does, after a
logistic calibration on the training texts.

The model is fitted by one task on at most ``TRAIN_DOCS`` labelled texts (chosen by a hash of the id, a
bound on memory); its weights, of fixed size, travel through the driver to the tasks that score. Scoring
works on batches of bounded size, apart from a single long text, whose windows are scored in parts; only
its cache of words is kept between them. Ids and other columns pass through as they are.

A null, empty or blank text is one empty window. Repeated rows get equal scores. A label that is
null, or whose text is null or missing, is not used; a text labelled twice counts as toxic if one label says
so. An empty table has no scores. Without labels of both kinds every text gets the share of toxic labels, by Laplace's rule.
"""

from __future__ import annotations

import io
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WINDOW, STRIDE = 32, 16
HALF, HIDDEN, ATTENTION = 8, 8, 8
VOCABULARY, TRIGRAMS = 20_000, 4096
TRAIN_DOCS = 2_000
EPOCHS, STEPS, BATCH, RATE = 4, 100, 64, 0.01
THRESHOLD = 0.3
CACHE_WORDS, CHUNK_WINDOWS, CHUNK_WORDS = 200_000, 2048, 200_000
ADDED = {"score": T.DoubleType(), "windows": T.LongType(), "worst_word": T.LongType()}

Arrays = dict[str, np.ndarray]
WORD = re.compile(r"\w+")


# --- inputs -----------------------------------------------------------------------------


def tokens(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def trigrams(word: str) -> list[int]:
    """Hashes of the character trigrams of a word with its ends marked."""
    marked = f"^{word}$"
    return [zlib.crc32(marked[i : i + 3].encode()) % TRIGRAMS for i in range(max(1, len(marked) - 2))]


def window_starts(n: int) -> range:
    """Starts of the windows that cover n words; one for a text without words."""
    return range(0, max(1, n - WINDOW + STRIDE), STRIDE) if n > WINDOW else range(1)


def windows_of(lengths: Sequence[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For texts laid end to end: each window's text, its first position and its number of words."""
    owner, first, count, at = [], [], [], 0
    for i, n in enumerate(lengths):
        for start in window_starts(n):
            owner.append(i), first.append(at + start), count.append(min(WINDOW, n - start))
        at += n
    return np.array(owner, np.int64), np.array(first, np.int64), np.array(count, np.int64)


# --- network ----------------------------------------------------------------------------


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def initial(vocabulary: int, seed: int = 1) -> Arrays:
    rng = np.random.default_rng(seed)
    draw = lambda *shape: (rng.standard_normal(shape) * 0.3).astype(np.float32)
    p = {"word": draw(vocabulary + 1, HALF) * 0.3, "char": draw(TRIGRAMS, HALF)}
    for side in "fb":
        p |= {f"W{side}": draw(2 * HALF, 3 * HIDDEN), f"U{side}": draw(HIDDEN, 3 * HIDDEN)}
        p[f"b{side}"] = np.zeros(3 * HIDDEN, np.float32)
    return p | {
        "A": draw(2 * HIDDEN, ATTENTION), "a": np.zeros(ATTENTION, np.float32), "v": draw(ATTENTION),
        "u": draw(2 * HIDDEN), "c": np.zeros(1, np.float32),
    }


def gru(inputs: np.ndarray, mask: np.ndarray, U: np.ndarray, back: bool, keep: bool = False):
    """States (steps, windows, HIDDEN) over projected inputs (steps, windows, 3 HIDDEN); unmasked steps keep the state."""
    steps, n, _ = inputs.shape
    h, states, saved = np.zeros((n, HIDDEN), np.float32), np.empty((steps, n, HIDDEN), np.float32), {}
    for t in range(steps - 1, -1, -1) if back else range(steps):
        x, g = inputs[t], h @ U
        zr = sigmoid(x[:, : 2 * HIDDEN] + g[:, : 2 * HIDDEN])
        z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
        c = np.tanh(x[:, 2 * HIDDEN :] + r * g[:, 2 * HIDDEN :])
        if keep:
            saved[t] = (h, z, r, c, g[:, 2 * HIDDEN :])
        h = np.where(mask[t][:, None], c + z * (h - c), h)
        states[t] = h
    return states, saved


def both_gru(inputs: np.ndarray, count: np.ndarray, U: np.ndarray) -> np.ndarray:
    """States (steps, windows, 2 HIDDEN) of both directions at once, for scoring.

    ``inputs`` is (steps, 2, windows, 3 HIDDEN), the second direction read from each window's last
    word, so that both end after ``count`` steps.
    """
    steps, _, n, _ = inputs.shape
    h, states = np.zeros((2, n, HIDDEN), np.float32), np.empty((steps, 2, n, HIDDEN), np.float32)
    full = count.min() if n else 0
    for t in range(steps):
        g = h @ U
        zr = np.tanh(0.5 * (inputs[t, ..., : 2 * HIDDEN] + g[..., : 2 * HIDDEN])) * 0.5 + 0.5
        c = np.tanh(inputs[t, ..., 2 * HIDDEN :] + zr[..., HIDDEN:] * g[..., 2 * HIDDEN :])
        new = c + zr[..., :HIDDEN] * (h - c)
        h = new if t < full else np.where((t < count)[:, None], new, h)
        states[t] = h
    back = np.clip(count - 1 - np.arange(steps)[:, None], 0, None)
    return np.concatenate([states[:, 0], states[back, 1, np.arange(n)]], 2)


def pool(p: Arrays, states: np.ndarray, mask: np.ndarray):
    """Logits of the windows, with what the gradient needs."""
    hidden = np.tanh(states @ p["A"] + p["a"])
    score = np.where(mask, hidden @ p["v"], -1e9)
    weight = np.exp(score - score.max(0)) * mask
    weight = weight / np.maximum(weight.sum(0), 1e-9)
    pooled = (weight[..., None] * states).sum(0)
    return pooled @ p["u"] + p["c"][0], hidden, weight, pooled


def forward(p: Arrays, x: np.ndarray, mask: np.ndarray, keep: bool = False):
    """Logits of windows of word vectors (steps, windows, 2 HALF)."""
    sides = [gru(x @ p[f"W{s}"] + p[f"b{s}"], mask, p[f"U{s}"], s == "b", keep) for s in "fb"]
    states = np.concatenate([s[0] for s in sides], 2) * mask[..., None]
    logit, hidden, weight, pooled = pool(p, states, mask)
    return logit, (sides, states, hidden, weight, pooled)


def gradients(p: Arrays, x: np.ndarray, mask: np.ndarray, d_logit: np.ndarray, kept) -> tuple[Arrays, np.ndarray]:
    """Gradients of the parameters and of the word vectors."""
    sides, states, hidden, weight, pooled = kept
    g = {"u": pooled.T @ d_logit, "c": d_logit.sum(keepdims=True)}
    d_pooled = d_logit[:, None] * p["u"]
    d_states = weight[..., None] * d_pooled
    d_weight = (states * d_pooled).sum(2)
    d_score = weight * (d_weight - (weight * d_weight).sum(0))
    g["v"] = np.einsum("tn,tna->a", d_score, hidden)
    d_hidden = d_score[..., None] * p["v"] * (1 - hidden**2)
    g["A"], g["a"] = np.einsum("tnh,tna->ha", states, d_hidden), d_hidden.sum((0, 1))
    d_states = (d_states + d_hidden @ p["A"].T) * mask[..., None]
    d_x = np.zeros_like(x)
    for i, s in enumerate("fb"):
        _, saved = sides[i]
        W, U = p[f"W{s}"], p[f"U{s}"]
        g[f"W{s}"], g[f"U{s}"], g[f"b{s}"] = np.zeros_like(W), np.zeros_like(U), np.zeros(3 * HIDDEN, np.float32)
        d_h = np.zeros((x.shape[1], HIDDEN), np.float32)
        order = range(len(x)) if s == "b" else range(len(x) - 1, -1, -1)
        for t in order:
            on = mask[t][:, None]
            h, z, r, c, gc = saved[t]
            d = d_states[t, :, i * HIDDEN : (i + 1) * HIDDEN] + d_h
            d_new = d * on
            d_c = d_new * (1 - z) * (1 - c**2)
            d_z = d_new * (h - c) * z * (1 - z)
            d_r = d_c * gc * r * (1 - r)
            d_in = np.concatenate([d_z, d_r, d_c], 1)
            d_rec = np.concatenate([d_z, d_r, d_c * r], 1)
            g[f"W{s}"] += x[t].T @ d_in
            g[f"b{s}"] += d_in.sum(0)
            g[f"U{s}"] += h.T @ d_rec
            d_x[t] += d_in @ W.T
            d_h = d * ~on + d_new * z + d_rec @ U.T
    return g, d_x


def mean_vectors(p: Arrays, own: np.ndarray, grams: np.ndarray, counts: Sequence[int]) -> np.ndarray:
    """Vectors of words with vocabulary numbers ``own``, whose trigrams lie end to end in ``grams``."""
    if not len(own):
        return np.zeros((0, 2 * HALF), np.float32)
    begin = np.cumsum(counts) - counts
    chars = np.add.reduceat(p["char"][grams], begin) / np.asarray(counts)[:, None]
    return np.concatenate([p["word"][own], chars], 1).astype(np.float32)


# --- model ------------------------------------------------------------------------------


@dataclass
class Model:
    """A fitted network with its vocabulary and calibration."""

    params: Arrays
    vocabulary: dict[str, int]
    scale: float = 1.0
    shift: float = 0.0
    constant: float | None = None
    _number: dict[str, int] = field(default_factory=dict)
    _table: list[np.ndarray] = field(default_factory=list)

    def vectors(self, words: Sequence[str]) -> np.ndarray:
        """Input vectors of distinct words."""
        unknown = len(self.vocabulary)
        grams = [trigrams(w) for w in words]
        own = np.array([self.vocabulary.get(w, unknown) for w in words], np.int64)
        return mean_vectors(self.params, own, np.array([g for gs in grams for g in gs], np.int64), [len(g) for g in grams])

    def window_logits(self, texts: Sequence[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Logit, text and first word of all windows of some texts."""
        lengths = [len(t) for t in texts]
        flat = [w for t in texts for w in t]
        number = self._number
        new = list({w for w in flat if w not in number})
        if len(number) + len(new) > CACHE_WORDS:
            number.clear(), self._table.clear()
            new = list(set(flat))
        if new or not self._table:
            number.update(zip(new, range(len(number), len(number) + len(new))))
            x, p = self.vectors(new), self.params
            both = np.concatenate([x @ p["Wf"] + p["bf"], x @ p["Wb"] + p["bb"]], 1)
            self._table[:] = [np.concatenate([*self._table, both])]
        table = np.concatenate([self._table[0], np.zeros((1, 6 * HIDDEN), np.float32)])
        ids = np.array([number[w] for w in flat] + [len(table) - 1] * WINDOW, np.int64)
        owner, first, count = windows_of(lengths)
        logits = np.empty(len(owner), np.float32)
        steps = np.arange(WINDOW)[:, None]
        recurrent = np.stack([self.params["Uf"], self.params["Ub"]])
        for at in range(0, len(owner), CHUNK_WINDOWS):
            part = slice(at, at + CHUNK_WINDOWS)
            mask = steps < count[part]
            ahead = np.where(mask, ids[first[part] + steps], len(table) - 1)
            back = np.where(mask, ids[first[part] + np.maximum(count[part] - 1 - steps, 0)], len(table) - 1)
            inputs = np.stack([table[ahead, : 3 * HIDDEN], table[back, 3 * HIDDEN :]], 1)
            states = both_gru(inputs, count[part], recurrent)
            logits[part] = pool(self.params, states * mask[..., None], mask)[0]
        starts = np.cumsum([0] + lengths)
        return logits, owner, first - starts[owner]

    def score(self, texts: Sequence[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Score, number of windows and first word of the worst window of each text."""
        logits, owner, start = self.window_logits(texts)
        begin = np.searchsorted(owner, np.arange(len(texts)))
        worst = np.maximum.reduceat(logits, begin) if len(texts) else np.zeros(0)
        is_worst = np.flatnonzero(logits == worst[owner])
        where = is_worst[np.searchsorted(owner[is_worst], np.arange(len(texts)))]
        if self.constant is None:
            score = sigmoid(worst.astype(np.float64) * self.scale + self.shift)
        else:
            score = np.full(len(texts), self.constant)
        return score, np.bincount(owner, minlength=len(texts)), start[where]


def fit(texts: Sequence[str | None], labels: Sequence[int], rate: float | None = None, seed: int = 1) -> Model:
    """Fit on texts with labels 0 and 1, of which a toxic one has at least one toxic window.

    Each epoch scores all windows; the worst window of every text and, for texts that are not toxic,
    some more stand for it in the gradient steps. A word's first coordinate starts as its log-odds
    among the training texts. ``rate`` is the share of toxic texts to calibrate to, if not that of the
    labels given.
    """
    y = np.asarray(labels, np.float32)
    if len(y) == 0 or y.min() == y.max():
        return Model(initial(0), {}, constant=(y.sum() + 1) / (len(y) + 2) if rate is None else rate)
    split = [tokens(t) for t in texts]
    seen = Counter(w for t in split for w in set(t))
    toxic = Counter(w for t, label in zip(split, y) if label for w in set(t))
    common = [w for w, n in sorted(seen.items(), key=lambda wn: (-wn[1], wn[0]))[:VOCABULARY] if n > 1]
    vocabulary = {w: i for i, w in enumerate(common)}
    p = initial(len(common), seed)
    odds = y.mean() / (1 - y.mean())
    p["word"][:, 0] = 0
    for w, i in vocabulary.items():
        t, n = toxic[w], seen[w]
        p["word"][i, 0] = np.clip(np.log((t + odds) / (n - t + 1) / odds) * n / (n + 4), -3, 3) / 1.5  # rare words count less
    model = Model(p, vocabulary)

    rng = np.random.default_rng(seed)
    moments = {k: (np.zeros_like(a), np.zeros_like(a)) for k, a in p.items()}
    lengths = [len(t) for t in split]
    offset = np.cumsum([0] + lengths)
    names = sorted({w for t in split for w in t})
    number = {w: i for i, w in enumerate(names)}
    flat = np.array([number[w] for t in split for w in t] + [0] * WINDOW, np.int64)
    word_of = np.array([vocabulary.get(w, len(vocabulary)) for w in names] or [0])
    grams_of = [trigrams(w) for w in names]
    n_grams = np.array([len(g) for g in grams_of], np.int64)
    gram_at, grams = np.cumsum(n_grams) - n_grams, np.array([g for gs in grams_of for g in gs], np.int64)
    owner, first, count = windows_of(lengths)
    begin = np.searchsorted(owner, np.arange(len(split)))
    end = np.append(begin[1:], len(owner))
    step_no, steps = 0, np.arange(WINDOW)[:, None]
    per_epoch = -(-(len(y) + 2 * int((y == 0).sum())) // BATCH)
    for epoch in range(max(EPOCHS, -(-STEPS // per_epoch))):  # small samples take more rounds
        if epoch == 0:  # the windows with the most telling words
            telling = np.append(0, np.cumsum(np.append(p["word"][word_of, 0][flat[: offset[-1]]], 0)))
            logits = telling[first + count] - telling[first]
        else:
            model._number.clear(), model._table.clear()
            logits = model.window_logits(split)[0]
        chosen = []
        for i, label in enumerate(y):
            own = np.arange(begin[i], end[i])
            chosen.append(own[np.argmax(logits[own])])
            if not label:
                chosen.extend(rng.choice(own, min(2, len(own)), replace=False))
        chosen = rng.permutation(np.array(chosen))
        for at in range(0, len(chosen), BATCH):
            part = chosen[at : at + BATCH]
            mask = steps < count[part]
            ids = np.where(mask, flat[first[part] + steps], 0)
            used, place = np.unique(ids, return_inverse=True)
            place = place.reshape(ids.shape)
            own_grams = grams[np.concatenate([np.arange(gram_at[i], gram_at[i] + n_grams[i]) for i in used])]
            x = mean_vectors(p, word_of[used], own_grams, n_grams[used])[place] * mask[..., None]
            logit, kept = forward(p, x, mask, keep=True)
            d_logit = ((sigmoid(logit) - y[owner[part]]) / len(part)).astype(np.float32)
            g, d_x = gradients(p, x, mask, d_logit, kept)
            d_words = np.zeros((len(used), 2 * HALF), np.float32)
            np.add.at(d_words, place.ravel(), (d_x * mask[..., None]).reshape(-1, 2 * HALF))
            g["word"], g["char"] = np.zeros_like(p["word"]), np.zeros_like(p["char"])
            np.add.at(g["word"], word_of[used], d_words[:, :HALF])
            np.add.at(g["char"], own_grams, np.repeat(d_words[:, HALF:] / n_grams[used][:, None], n_grams[used], 0))
            step_no += 1
            for k, a in p.items():  # Adam
                m, v = moments[k]
                m += 0.1 * (g[k] - m)
                v += 0.01 * (g[k] ** 2 - v)
                a -= RATE * (m / (1 - 0.9**step_no)) / (np.sqrt(v / (1 - 0.99**step_no)) + 1e-8)
    model._number.clear(), model._table.clear()
    logits = model.window_logits(split)[0]
    model._number.clear(), model._table.clear()
    rate = y.mean() if rate is None else rate
    weight = np.where(y == 1, rate / y.mean(), (1 - rate) / (1 - y.mean()))
    model.scale, model.shift = calibrate(np.maximum.reduceat(logits, begin), y, weight)
    return model


def calibrate(worst: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Scale and shift of the logistic curve through (logit, label); Newton's method with a weak prior."""
    x = np.stack([worst, np.ones_like(worst)], 1).astype(np.float64)
    w = np.array([1.0, 0.0])
    for _ in range(30):
        q = sigmoid(x @ w)
        grad = x.T @ (weight * (q - y)) + 0.1 * (w - [1.0, 0.0])
        curve = (x * (weight * q * (1 - q))[:, None]).T @ x + 0.1 * np.eye(2)
        move = np.linalg.solve(curve, grad)
        w -= move / max(1.0, np.abs(move).max())
    return max(float(w[0]), 1e-3), float(w[1])


# --- Spark ------------------------------------------------------------------------------


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


FITTED = "params binary, vocabulary array<string>, scale double, shift double, constant double"


def fit_rows(rate: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task that fits on the rows (doc_id, text, toxic) it gets and returns the model as one row."""

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted(row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
        model = fit([text for _, text, _ in rows], [toxic for _, _, toxic in rows], rate)
        params = io.BytesIO()
        np.savez(params, **model.params)
        values = [params.getvalue(), list(model.vocabulary), model.scale, model.shift, model.constant]
        kinds = [pa.binary(), pa.list_(pa.string()), pa.float64(), pa.float64(), pa.float64()]
        names = [field.split()[0] for field in FITTED.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names)

    return fitted


def train(docs: DataFrame, labels: DataFrame, most: int = TRAIN_DOCS) -> Model:
    """Fit on labelled texts that are not held out, at most ``most`` / 2 of either label.

    One task fits, so that the driver holds no texts, only the weights. Of several texts of one doc_id the
    last in order counts. The share of toxic labels for the calibration is counted over all of them.
    """
    usable = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    marked = usable.groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    counts = {r.toxic: r.n for r in marked.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    halves = [
        marked.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most // 2) for label in (0, 1)
    ]
    ids = F.broadcast(halves[0].union(halves[1]))  # at most ``most`` rows
    texts = docs.select("doc_id", "text").where("text IS NOT NULL").join(ids, "doc_id")
    texts = texts.groupBy("doc_id", "toxic").agg(F.max("text").alias("text")).select("doc_id", "text", "toxic")
    rate = (counts.get(1, 0) + 1) / (sum(counts.values()) + 2)
    rows = texts.repartition(1).mapInArrow(fit_rows(rate), FITTED).collect()  # the weights, of fixed size
    if not rows:
        return fit([], [], rate)
    row = rows[0]
    params = dict(np.load(io.BytesIO(row.params)))
    return Model(params, {w: i for i, w in enumerate(row.vocabulary)}, row.scale, row.shift, row.constant)


def score_documents(docs: DataFrame, model: Model, keep: Iterable[str] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` of every row with its ``score``, number of ``windows`` and ``worst_word``,
    the first word of the worst window; columns of these names are replaced. Kept columns pass as they are."""
    keep = [c for c in keep if c not in ADDED]
    schema = T.StructType([docs.schema[c] for c in keep])
    for name, kind in ADDED.items():
        schema = schema.add(name, kind)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, held, n = [], [], 0
            for text in batch.column(batch.num_columns - 1):
                held.append(tokens(text.as_py()))
                n += len(held[-1])
                if n > CHUNK_WORDS:
                    found.append(model.score(held))
                    held, n = [], 0
            if held:
                found.append(model.score(held))
            added = [np.concatenate([f[i] for f in found]) if found else np.zeros(0) for i in range(len(ADDED))]
            kinds = (pa.float64(), pa.int64(), pa.int64())
            columns = batch.columns[:-1] + [pa.array(a.astype(k.to_pandas_dtype()), k) for a, k in zip(added, kinds)]
            yield pa.RecordBatch.from_arrays(columns, [*keep, *ADDED])

    return docs.select(*keep, F.col("text").alias("_text")).mapInArrow(scored, schema)


def drop_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score below the threshold."""
    return score_documents(docs, model, docs.columns).where(F.col("score") < threshold).select(*docs.columns)
