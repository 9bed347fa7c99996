"""Toxicity by a bidirectional gated recurrent network with attention pooling, trained in numpy.

A word enters as a hashed embedding of itself plus the mean of hashed embeddings of its character
n-grams, so that unseen words with known stems count. A text is scored over all its overlapping
windows; its score is that of its most toxic window. Training learns which window of a toxic text
is the toxic one: first from sampled windows of all texts, then from the windows that score highest.
"""

from __future__ import annotations

import io
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmarts.llm.common import kept

WINDOW, STRIDE = 32, 16
HIDDEN = 8
WORD_ROWS, WORD_DIM = 1 << 15, 6
GRAM_ROWS, GRAM_DIM = 1 << 15, 10
# Rows of both tables met in fewer training texts stay zero, as those of unseen words do.
MIN_TEXTS = 3
GRAMS = (3, 4, 5)
CUTOFF = 0.7
# Labelled rows of each class that serve for training at most, and windows of each.
TRAIN_ROWS = 1500
TRAIN_WINDOWS = 24
ROUNDS = 7
# Steps of a round at least.
STEPS = 40
SEED = 7
# Share of each word's n-grams that every other batch goes without.
GRAM_DROPOUT = 0.8
# Words whose features are made together.
SLICE = 20_000
# Distinct words a worker remembers before it starts anew.
REMEMBERED = 200_000
_EDGE = "".join(chr(c) for c in range(0x21, 0x7F) if not chr(c).isalnum()) + "«»„“”‘’…–—"


def words_of(text: str | None) -> list[str]:
    return (text or "").lower().split()


def word_features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row of the word table, rows of the n-gram table and where each word's n-grams start."""
    cores = [word.strip(_EDGE) or word for word in words]
    coded = [b"^" + core.encode("utf-8", "surrogatepass") + b"$" for core in cores]
    own = np.array([zlib.crc32(x) % WORD_ROWS for x in coded], np.int64)
    flat = np.frombuffer(b"".join(coded), np.uint8).astype(np.uint64)
    lengths = np.array(list(map(len, coded)), np.int64)
    ends = np.cumsum(lengths)
    left = np.repeat(ends, lengths) - np.arange(len(flat))
    owner = np.repeat(np.arange(len(words)), lengths)
    rows, owners = [], []
    for n in GRAMS:
        hashed = np.full(len(flat), n, np.uint64)
        for k in range(n):
            hashed = (hashed ^ np.roll(flat, -k)) * np.uint64(0x9E3779B97F4A7C15)
            hashed ^= hashed >> np.uint64(29)
        # The shortest n-grams also stand for words of fewer characters.
        whole = left >= n
        rows.append((hashed[whole] % np.uint64(GRAM_ROWS)).astype(np.int64))
        owners.append(owner[whole])
    order = np.argsort(np.concatenate(owners), kind="stable")
    owners = np.concatenate(owners)[order]
    return own, np.concatenate(rows)[order], np.searchsorted(owners, np.arange(len(words) + 1))


def features_of(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``word_features`` of many words, made for some at a time."""
    parts = [word_features(words[n : n + SLICE]) for n in range(0, len(words), SLICE)]
    ends = np.cumsum([0] + [part[2][-1] for part in parts])
    starts = [part[2][:-1] + end for part, end in zip(parts, ends, strict=False)]
    rows = np.concatenate([part[1].astype(np.int32) for part in parts])
    return np.concatenate([part[0] for part in parts]), rows, np.concatenate([*starts, ends[-1:]])


def gram_means(table: np.ndarray, rows: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Mean of the table rows of each word; every word has at least one n-gram."""
    sums = np.add.reduceat(table[rows], starts[:-1], axis=0)
    return sums / np.diff(starts)[:, None].astype(np.float32)


def window_starts(length: int) -> list[int]:
    """Starts of the windows that cover a text: one at least, the last one reaching its end."""
    return list(range(0, max(1, length - WINDOW + STRIDE), STRIDE))


def new_model(seed: int = SEED) -> dict[str, np.ndarray]:
    draw = np.random.default_rng(seed)
    size = WORD_DIM + GRAM_DIM

    def normal(*shape, scale):
        return (draw.standard_normal(shape) * scale).astype(np.float32)

    model = {"words": normal(WORD_ROWS, WORD_DIM, scale=0.1), "grams": normal(GRAM_ROWS, GRAM_DIM, scale=0.3)}
    for side in "fb":
        model |= {
            f"w{side}": normal(size, 3 * HIDDEN, scale=0.3), f"u{side}": normal(HIDDEN, 3 * HIDDEN, scale=0.3),
            f"c{side}": np.zeros(3 * HIDDEN, np.float32),
        }
    return model | {
        "attend": normal(2 * HIDDEN, scale=0.3), "out": normal(2 * HIDDEN, scale=0.3), "bias": np.zeros(1, np.float32),
    }


def _sigmoid(x):
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _run(gates: np.ndarray, recurrent: np.ndarray, mask: np.ndarray, backward: bool, trace: list | None):
    """States over time of one direction; gates (T, B, 3H) are those of the input, mask is (T, B, 1)."""
    steps, batch, _ = gates.shape
    states = np.zeros((steps, batch, HIDDEN), np.float32)
    state = np.zeros((batch, HIDDEN), np.float32)
    for t in range(steps - 1, -1, -1) if backward else range(steps):
        rec = state @ recurrent
        both = _sigmoid(gates[t, :, : 2 * HIDDEN] + rec[:, : 2 * HIDDEN])
        update, reset = both[:, :HIDDEN], both[:, HIDDEN:]
        fresh = np.tanh(gates[t, :, 2 * HIDDEN :] + reset * rec[:, 2 * HIDDEN :])
        before = state
        state = before + mask[t] * (1 - update) * (fresh - before)
        states[t] = state
        if trace is not None:
            trace.append((t, before, rec[:, 2 * HIDDEN :], update, reset, fresh))
    return states


def forward(model, gates_f, gates_b, mask, traces=None):
    """Logits of windows. mask is (T, B), 1 where there is a word."""
    traces = traces if traces is not None else {}
    wide = mask[:, :, None]
    keep = traces.get("keep")
    states = np.concatenate([
        _run(gates_f, model["uf"], wide, False, traces.setdefault("f", []) if keep else None),
        _run(gates_b, model["ub"], wide, True, traces.setdefault("b", []) if keep else None),
    ], axis=2)
    weights = np.where(mask > 0, states @ model["attend"], -1e9)
    weights = np.exp(weights - weights.max(axis=0)) * mask
    weights /= np.maximum(weights.sum(axis=0), 1e-9)
    pooled = np.einsum("tb,tbh->bh", weights, states)
    if keep:
        traces |= {"states": states, "weights": weights, "pooled": pooled}
    return pooled @ model["out"] + model["bias"][0]


def _back(gates_grad, trace, states_grad, recurrent, mask):
    """Gradient of one direction: fills gates_grad, returns that of the recurrent weights."""
    grad_u = np.zeros_like(recurrent)
    carried = np.zeros_like(states_grad[0])
    for t, before, rec, update, reset, fresh in reversed(trace):
        grad = carried + states_grad[t]
        part = mask[t][:, None] * grad
        d_update = part * (before - fresh) * update * (1 - update)
        d_fresh = part * (1 - update) * (1 - fresh * fresh)
        d_reset = d_fresh * rec * reset * (1 - reset)
        gates_grad[t] = np.concatenate([d_update, d_reset, d_fresh], axis=1)
        into = np.concatenate([d_update, d_reset, d_fresh * reset], axis=1)
        grad_u += before.T @ into
        carried = grad - part * (1 - update) + into @ recurrent.T
    return grad_u


def gradients(model, features, index, mask, labels, weights, heard=1.0):
    """Loss gradients of a batch of windows; index (T, B) points into ``features``' words.

    ``heard`` scales the words' own embeddings, so that n-grams learn to do without them.
    """
    own, rows, starts = features
    vectors = np.concatenate([model["words"][own] * heard, gram_means(model["grams"], rows, starts)], axis=1)
    inputs = vectors[index]
    gates = {side: inputs @ model[f"w{side}"] + model[f"c{side}"] for side in "fb"}
    traces = {"keep": True}
    logits = forward(model, gates["f"], gates["b"], mask, traces)
    error = (_sigmoid(logits) - labels) * weights / len(labels)
    grads = {"bias": error.sum(keepdims=True), "out": traces["pooled"].T @ error}
    pooled_grad = error[:, None] * model["out"]
    states, share = traces["states"], traces["weights"]
    along = np.einsum("tbh,bh->tb", states, pooled_grad)
    score_grad = share * (along - (share * along).sum(axis=0))
    grads["attend"] = np.einsum("tb,tbh->h", score_grad, states)
    states_grad = share[:, :, None] * pooled_grad + score_grad[:, :, None] * model["attend"]
    inputs_grad = np.zeros_like(inputs)
    for side, part in (("f", states_grad[:, :, :HIDDEN]), ("b", states_grad[:, :, HIDDEN:])):
        gates_grad = np.zeros_like(gates[side])
        grads[f"u{side}"] = _back(gates_grad, traces[side], part, model[f"u{side}"], mask)
        flat = gates_grad.reshape(-1, 3 * HIDDEN)
        grads[f"w{side}"] = inputs.reshape(len(flat), -1).T @ flat
        grads[f"c{side}"] = flat.sum(axis=0)
        inputs_grad += gates_grad @ model[f"w{side}"].T
    inputs_grad *= mask[:, :, None]
    per_word = _summed(len(vectors), index.ravel(), inputs_grad.reshape(-1, vectors.shape[1]))
    counts = np.diff(starts)
    grads["words"] = _summed(WORD_ROWS, own, per_word[:, :WORD_DIM] * heard)
    grads["grams"] = _summed(GRAM_ROWS, rows, np.repeat(per_word[:, WORD_DIM:] / counts[:, None], counts, axis=0))
    return grads


def _summed(size: int, at: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums of the values of each place."""
    order = np.argsort(at, kind="stable")
    placed = at[order]
    starts = np.flatnonzero(np.append(True, placed[1:] != placed[:-1]))
    out = np.zeros((size, values.shape[1]), np.float32)
    out[placed[starts]] = np.add.reduceat(values[order], starts, axis=0)
    return out


def windows_matrix(codes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Windows (word codes) as index (T, B) and mask (T, B)."""
    index = np.zeros((WINDOW, len(codes)), np.int64)
    mask = np.zeros((WINDOW, len(codes)), np.float32)
    for b, code in enumerate(codes):
        index[: len(code), b], mask[: len(code), b] = code, 1
    return index, mask


def train(texts: Iterable[list[list[str]]], labels: list[int], seed: int = SEED, rounds: int = ROUNDS) -> dict[str, np.ndarray]:
    """Model from the sampled windows (lists of words) of labelled texts."""
    model, draw = new_model(seed), np.random.default_rng(seed)
    if not labels or len(set(labels)) < 2:
        return model
    vocabulary: dict[str, int] = {}
    codes = [[np.array([vocabulary.setdefault(w, len(vocabulary)) for w in win], np.int64) for win in text] for text in texts]
    if not vocabulary:
        return model
    own, rows, starts = features_of(list(vocabulary))
    learnt = {name: _met(codes, at, bounds, size) for name, at, bounds, size in (
        ("words", own, np.arange(len(own) + 1), WORD_ROWS), ("grams", rows, starts, GRAM_ROWS),
    )}
    for name, mask in learnt.items():
        model[name] *= mask
    sums = {name: np.zeros_like(value) for name, value in model.items()}
    squares = {name: np.zeros_like(value) for name, value in model.items()}
    step = 0
    for number in range(rounds):
        if number < 2:
            chosen = [(t, w) for t, text in enumerate(codes) for w in (range(len(text)) if labels[t] else range(min(3, len(text))))]
        else:
            logits = window_logits(model, [w for text in codes for w in text], (own, rows, starts))
            at, chosen = 0, []
            for t, text in enumerate(codes):
                best = np.argsort(-logits[at : at + len(text)], kind="stable")[: 2 if labels[t] == 0 else 1]
                chosen += [(t, int(w)) for w in best]
                at += len(text)
        truth = np.array([labels[t] for t, _ in chosen], np.float32)
        toxic = max(1.0, truth.sum())
        weight = np.where(truth > 0, len(truth) / (2 * toxic), len(truth) / (2 * max(1.0, len(truth) - toxic))).astype(np.float32)
        # Small samples take smaller batches and more passes, so that every round has steps enough.
        size = min(256, max(32, len(chosen) // 16))
        for _ in range(max(2, -(-STEPS // -(-len(chosen) // size)))):
            order = draw.permutation(len(chosen))
            for start in range(0, len(order), size):
                batch = order[start : start + size]
                index, mask = windows_matrix([codes[chosen[i][0]][chosen[i][1]] for i in batch])
                used, local = np.unique(index, return_inverse=True)
                counts = np.diff(starts)[used]
                offsets = np.concatenate([[0], np.cumsum(counts)])
                at = np.repeat(starts[used] - offsets[:-1], counts) + np.arange(offsets[-1])
                part, heard = (own[used], rows[at], offsets), 1.0
                if step % 2:
                    # Every other batch goes without most words and n-grams, so that known stems count in unseen words.
                    part, heard = (own[used], *_some_grams(draw, rows[at], offsets)), np.float32(0)
                grads = gradients(model, part, local.reshape(index.shape), mask, truth[batch], weight[batch], heard)
                step += 1
                for name, mask in learnt.items():
                    grads[name] *= mask
                for name, grad in grads.items():
                    sums[name] = 0.9 * sums[name] + 0.1 * grad
                    squares[name] = 0.98 * squares[name] + 0.02 * grad * grad
                    move = (sums[name] / (1 - 0.9**step)) / (np.sqrt(squares[name] / (1 - 0.98**step)) + 1e-6)
                    model[name] = (model[name] - 0.02 * move).astype(np.float32)
    return model


def _some_grams(draw, rows: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Some of each word's n-grams, one at least: a few known ones must do in an unseen word."""
    order = draw.random(len(rows))
    owner = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    best = np.minimum.reduceat(order, starts[:-1])
    keep = (order >= GRAM_DROPOUT) | (order == best[owner])
    return rows[keep], np.concatenate([[0], np.cumsum(np.bincount(owner[keep], minlength=len(starts) - 1))])


def _met(codes: list[list[np.ndarray]], rows: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """1 for the table rows that words of ``MIN_TEXTS`` texts or more use, as a column."""
    count = np.zeros(size, np.int64)
    for text in codes:
        used = np.unique(np.concatenate(text)) if text else np.zeros(0, np.int64)
        lengths = starts[used + 1] - starts[used]
        at = np.repeat(starts[used] - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())
        count[np.unique(rows[at])] += 1
    return (count >= MIN_TEXTS).astype(np.float32)[:, None]


def word_gates(model, features) -> tuple[np.ndarray, np.ndarray]:
    """What each word adds to the gates of both directions."""
    own, rows, starts = features
    vectors = np.concatenate([model["words"][own], gram_means(model["grams"], rows, starts)], axis=1)
    return vectors @ model["wf"] + model["cf"], vectors @ model["wb"] + model["cb"]


def window_logits(model, windows: list[np.ndarray], features) -> np.ndarray:
    gates_f, gates_b = word_gates(model, features)
    out = []
    for start in range(0, len(windows), 2048):
        index, mask = windows_matrix(windows[start : start + 2048])
        out.append(forward(model, gates_f[index], gates_b[index], mask))
    return np.concatenate(out)


class Scorer:
    """Scores texts; remembers what each distinct word adds to the gates."""

    def __init__(self, model):
        self.model = model
        self.forget()

    def forget(self):
        self.index = _Index()
        self.gates_f = np.zeros((1, 3 * HIDDEN), np.float32)
        self.gates_b = np.zeros((1, 3 * HIDDEN), np.float32)
        self.known = 1

    def codes(self, words: list[str]) -> np.ndarray:
        """Places of words in the gate tables; 0 is no word."""
        if len(self.index) > REMEMBERED:
            self.forget()
        codes = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
        if self.index.fresh:
            f, b = word_gates(self.model, word_features(self.index.fresh))
            self.index.fresh = []
            size = self.known + len(f)
            if size > len(self.gates_f):
                grown = max(size, 2 * len(self.gates_f))
                self.gates_f = np.resize(self.gates_f, (grown, 3 * HIDDEN))
                self.gates_b = np.resize(self.gates_b, (grown, 3 * HIDDEN))
            self.gates_f[self.known : size], self.gates_b[self.known : size] = f, b
            self.known = size
        return codes

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """Highest window probability of each text."""
        listed = [words_of(text) for text in texts]
        codes = self.codes([word for words in listed for word in words])
        codes = np.append(codes, np.zeros(WINDOW, np.int64))
        first, length, owner, at = [], [], [], 0
        for t, words in enumerate(listed):
            starts = window_starts(len(words))
            first += [at + s for s in starts]
            length += [min(WINDOW, len(words) - s) for s in starts]
            owner += [t] * len(starts)
            at += len(words)
        first, length = np.array(first, np.int64), np.array(length, np.int64)
        logits = np.empty(len(first), np.float32)
        steps = np.arange(WINDOW)[:, None]
        for start in range(0, len(first), 2048):
            part = slice(start, start + 2048)
            mask = (steps < length[part][None, :]).astype(np.float32)
            index = np.where(mask > 0, codes[np.minimum(first[part][None, :] + steps, len(codes) - 1)], 0)
            logits[part] = forward(self.model, self.gates_f[index], self.gates_b[index], mask)
        best = np.full(len(texts), -np.inf, np.float64)
        np.maximum.at(best, np.array(owner, np.int64), logits.astype(np.float64))
        return 1 / (1 + np.exp(-best))


class _Index(dict):
    """Numbers words from 1 in order of appearance and lists the fresh ones."""

    def __init__(self):
        self.fresh: list[str] = []

    def __missing__(self, word: str) -> int:
        self.fresh.append(word)
        self[word] = number = len(self) + 1
        return number


def training_windows(labelled: DataFrame, windows: int = TRAIN_WINDOWS) -> DataFrame:
    """``doc_id, toxic, windows``: up to ``windows`` windows of each text, drawn evenly from the whole text by its id."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_id, toxic, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = words_of(text)
                starts = window_starts(len(words))
                if len(starts) > windows:
                    draw = np.random.default_rng(zlib.crc32(str(doc_id).encode()))
                    starts = [starts[i] for i in draw.choice(len(starts), windows, replace=False)]
                made = [words[s : s + WINDOW] for s in starts]
                yield pa.RecordBatch.from_arrays([
                    pa.array([doc_id], pa.int64()), pa.array([int(toxic)], pa.int64()),
                    pa.array([made], pa.list_(pa.list_(pa.string()))),
                ], ["doc_id", "toxic", "windows"])

    sample = labelled.select("doc_id", "toxic", "text")
    return sample.mapInArrow(cut, "doc_id long, toxic long, windows array<array<string>>")


def fit(
    documents: DataFrame, labels: DataFrame, *, rows: int = TRAIN_ROWS, windows: int = TRAIN_WINDOWS, seed: int = SEED
) -> dict[str, np.ndarray]:
    """Model from the labelled documents that are not held out, of which a bounded sample serves.

    Per class those are the ``rows`` ids with the smallest hashes, and of each text ``windows`` windows. Documents with NULL id or label do not serve; ids with contradicting labels count as toxic.
    """
    marks = labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int")).dropna()
    marks = marks.filter(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    # Ids are chosen before texts are read, so texts of the sample alone are moved.
    order = F.xxhash64("doc_id")
    chosen = [marks.filter(F.col("toxic") == label).orderBy(order, "doc_id").limit(rows) for label in (0, 1)]
    chosen = F.broadcast(chosen[0].union(chosen[1]))
    texts = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    sample = training_windows(texts.join(chosen, "doc_id"), windows)
    # The sample is bounded, so one task can learn from it; the driver only meets the model.
    learnt = kept(sample.repartition(1).mapInArrow(_learn(seed), "model binary"), "model").first()
    if learnt is None:
        return new_model(seed)
    with np.load(io.BytesIO(learnt.model)) as held:
        return {name: held[name] for name in held.files}


def _learn(seed: int):
    """The model of ``doc_id, toxic, windows`` rows, as the bytes of an archive of arrays."""

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not held:
            return
        sample = pa.Table.from_batches(held)
        places = [zlib.crc32(str(x).encode()) for x in sample["doc_id"].to_pylist()]
        sample = sample.append_column("place", pa.array(places, pa.int64()))
        sample = sample.sort_by([("place", "ascending"), ("doc_id", "ascending"), ("toxic", "ascending")])
        # One text at a time becomes Python strings; the rest stays in Arrow's buffers.
        model = train((one.as_py() for one in sample["windows"]), sample["toxic"].to_pylist(), seed)
        out = io.BytesIO()
        np.savez(out, **model)
        yield pa.RecordBatch.from_arrays([pa.array([out.getvalue()], pa.binary())], ["model"])

    return learn


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def score_column(model: dict[str, np.ndarray], text: Column) -> Column:
    """Score of a text; NULL counts as empty."""

    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(model)
        for batch in texts:
            parts = [scorer.scores(batch.iloc[n : n + 500].tolist()) for n in range(0, len(batch), 500)]
            yield pd.Series(np.concatenate(parts) if parts else np.zeros(0))

    return F.pandas_udf(score, "double")(F.coalesce(text.cast("string"), F.lit("")))


def toxicity(
    documents: DataFrame, model: dict[str, np.ndarray], *, key: str = "doc_id", text: str = "text", cutoff: float = CUTOFF
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row, the score from its text alone.

    A text without words has the score of an empty window. Equal texts have equal scores; a NULL
    id is not held out. Other columns are not read; an empty table gives an empty result.
    """
    scored = documents.select(F.col(key).cast("long").alias("doc_id"), score_column(model, F.col(text)).alias("score"))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= cutoff).cast("int").alias("predicted")
    )


def drop_toxic(documents: DataFrame, model: dict[str, np.ndarray], *, text: str = "text", cutoff: float = CUTOFF) -> DataFrame:
    """The documents below the cutoff, with all their columns."""
    rows = documents.select(F.struct("*").alias("row"), score_column(model, F.col(text)).alias("score"))
    return rows.filter(F.col("score") < cutoff).select("row.*")
