"""Language of whole texts by a bidirectional gated recurrent network over bytes, trained here by backpropagation through time.

The network reads runs of bytes in both directions and labels every byte with the probability of each language; a document's
probabilities are the means over all its bytes. Long texts are cut into runs of fixed length, which are read side by side.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelmill.llm.shared import give_back, only, schema, small_batches
from reelmill.llm.words import raw, slices

RUN = 64  # bytes that are read in one go
HIDDEN = 12  # units of each direction
MOST_LANGUAGES = 1000  # the bound of the training sample: so many languages,
DOCS_PER_LANGUAGE = 400  # so many documents of a language,
RUNS_PER_DOC = 8  # and so many runs of each
STEPS = 400
BATCH = 256
RATE = 0.02
UNDECIDED = "und"
JUDGED_BYTES = 200  # shorter texts are never rejected for their score
EVIDENCE = 100  # right answers that it takes to tell what a low score is
SCORE_MARGIN = 0.85  # of the lowest scores seen
FOLDS = 5  # documents whose id has remainder 0 are held out of the fit


@dataclass
class Model:
    """``inputs``: a row of gate inputs for each byte; gates are update, reset and candidate, each of ``HIDDEN`` units.
    ``pairs``: which pairs of bytes (first * 256 + second) the training runs hold; all if it was not trained."""

    languages: list[str]
    inputs: list[np.ndarray]  # per direction (3H, 256)
    recurrent: list[np.ndarray]  # per direction (3H, H)
    output: np.ndarray  # (languages, 2H)
    bias: np.ndarray  # (languages, 1)
    pairs: np.ndarray = field(default_factory=lambda: np.ones(1 << 16, bool))

    def parameters(self) -> list[np.ndarray]:
        return [*self.inputs, *self.recurrent, self.output, self.bias]


def new_model(languages: list[str], hidden: int = HIDDEN, seed: int = 0) -> Model:
    rng = np.random.default_rng(seed)

    def draw(*shape: int, scale: float) -> np.ndarray:
        return rng.normal(0, scale, shape).astype(np.float32)

    return Model(languages, [draw(3 * hidden, 256, scale=0.3) for _ in range(2)],
                 [draw(3 * hidden, hidden, scale=0.8 / hidden ** 0.5) for _ in range(2)],
                 draw(len(languages), 2 * hidden, scale=0.3), np.zeros((len(languages), 1), np.float32))


def _step(inputs: np.ndarray, recurrent: np.ndarray, byte: np.ndarray, state: np.ndarray, gates: np.ndarray,
          turned: np.ndarray) -> None:
    """One step in place; ``gates`` and ``turned`` are working space (3H, batch) and hold the gates and U h afterwards."""
    hidden = len(state)
    np.take(inputs, byte, axis=1, out=gates, mode="clip")
    np.matmul(recurrent, state, out=turned)
    sides = gates[:2 * hidden]
    sides += turned[:2 * hidden]
    np.tanh(np.multiply(sides, 0.5, out=sides), out=sides)
    sides += 1
    sides *= 0.5
    new = gates[2 * hidden:]
    new += sides[hidden:] * turned[2 * hidden:]
    np.tanh(new, out=new)
    state -= new
    state *= sides[:hidden]
    state += new


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=0))
    return x / x.sum(axis=0)


def position_probabilities(model: Model, runs: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Probabilities (position, language, run) for runs of bytes (position, run) of the given lengths."""
    size, batch = runs.shape
    hidden = model.recurrent[0].shape[1]
    gates, turned = np.empty((3 * hidden, batch), np.float32), np.empty((3 * hidden, batch), np.float32)
    scores = np.empty((size, len(model.languages), batch), np.float32)
    for side in (0, 1):
        state = np.zeros((hidden, batch), np.float32)
        weights = np.ascontiguousarray(model.output[:, side * hidden:(side + 1) * hidden])
        for t in range(size) if side == 0 else range(size - 1, -1, -1):
            _step(model.inputs[side], model.recurrent[side], runs[t], state, gates, turned)
            if side:
                if lengths.min() <= t:
                    state *= t < lengths  # the backward state starts at the run's last byte
                scores[t] += weights @ state
            else:
                scores[t] = weights @ state + model.bias
    np.exp(np.minimum(scores, 60, out=scores), out=scores)
    scores /= scores.sum(axis=1, keepdims=True)
    return scores


def gradients(model: Model, runs: np.ndarray, labels: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean cross entropy over all positions of full runs (position, run), and its gradients by parameter."""
    size, batch = runs.shape
    hidden = model.recurrent[0].shape[1]
    states, gates, turned = [], [], []
    for side in (0, 1):
        state = np.zeros((hidden, batch), np.float32)
        s, g, u = np.empty((size, hidden, batch), np.float32), [], []
        for t in range(size) if side == 0 else range(size - 1, -1, -1):
            one, two = np.empty((3 * hidden, batch), np.float32), np.empty((3 * hidden, batch), np.float32)
            _step(model.inputs[side], model.recurrent[side], runs[t], state, one, two)
            s[t] = state
            g.append(one)
            u.append(two)
        states.append(s)
        gates.append(g)
        turned.append(u)
    both = np.concatenate(states, axis=1)  # (position, 2H, run)
    probabilities = _softmax(np.moveaxis(model.output @ both + model.bias, 1, 0))  # (language, position, run)
    right = probabilities[labels, :, np.arange(batch)]
    loss = float(-np.log(np.maximum(right, 1e-9)).mean())
    error = probabilities
    error[labels, :, np.arange(batch)] -= 1
    error = np.moveaxis(error, 0, 1) / np.float32(size * batch)  # (position, language, run)
    d_output = np.einsum("tcb,thb->ch", error, both, optimize=True)
    d_bias = error.sum(axis=(0, 2))[:, None]
    d_states = model.output.T @ error
    d_inputs, d_recurrent = [], []
    for side in (0, 1):
        order = list(range(size) if side == 0 else range(size - 1, -1, -1))
        d_u = np.zeros_like(model.recurrent[side])
        d_x = np.zeros_like(model.inputs[side])
        carried = np.zeros((hidden, batch), np.float32)
        for k in range(size - 1, -1, -1):
            t = order[k]
            before = states[side][order[k - 1]] if k else np.zeros((hidden, batch), np.float32)
            z, r, n = (gates[side][k][i * hidden:(i + 1) * hidden] for i in range(3))
            turn = turned[side][k][2 * hidden:]
            d = carried + d_states[t, side * hidden:(side + 1) * hidden]
            d_n = d * (1 - z) * (1 - n * n)
            d_z = d * (before - n) * z * (1 - z)
            d_r = d_n * turn * r * (1 - r)
            d_gates = np.concatenate([d_z, d_r, d_n])
            d_turned = np.concatenate([d_z, d_r, d_n * r])
            d_u += d_turned @ before.T
            np.add.at(d_x.T, runs[t], d_gates.T)
            carried = d * z + model.recurrent[side].T @ d_turned
        d_inputs.append(d_x)
        d_recurrent.append(d_u)
    return loss, [*d_inputs, *d_recurrent, d_output, d_bias]


def train(languages: list[str], runs: np.ndarray, labels: np.ndarray, steps: int = STEPS, seed: int = 0) -> Model:
    """Fit by Adam on runs (run, position) with their labels; languages are drawn equally often."""
    model = new_model(languages, seed=seed)
    rng = np.random.default_rng(seed)
    model.pairs[:] = False
    for i in range(runs.shape[1] - 1):
        model.pairs[runs[:, i].astype(np.uint16) << 8 | runs[:, i + 1]] = True
    own = [np.flatnonzero(labels == k) for k in range(len(languages))]
    first = [np.zeros_like(p) for p in model.parameters()]
    second = [np.zeros_like(p) for p in model.parameters()]
    for step in range(1, steps + 1):
        chosen = np.concatenate([rng.choice(x, -(-BATCH // len(own))) for x in own])
        _, found = gradients(model, runs[chosen].T.astype(np.intp), labels[chosen])
        norm = float(np.sqrt(sum(float((g * g).sum()) for g in found)))
        rate = RATE * min(1.0, 3 * (1 - (step - 1) / steps))
        for p, g, a, b in zip(model.parameters(), found, first, second, strict=True):
            g = g / max(1.0, norm)
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            p -= (rate * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.99 ** step)) + 1e-6)).astype(np.float32)
    return model


def remainder(doc_id: Column, folds: int) -> Column:
    """CRC-32 of the id as text, modulo ``folds``; missing for a missing id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def fit(docs: DataFrame, docs_per_language: int = DOCS_PER_LANGUAGE, runs_per_doc: int = RUNS_PER_DOC,
        steps: int = STEPS) -> Model:
    """A model of the languages of labelled documents (``doc_id``, ``text``, ``lang``), fitted on the driver.

    The sample is bounded by ``MOST_LANGUAGES`` languages, the most frequent ones, ``docs_per_language`` documents of each, those
    with the smallest hashes of id and text, and ``runs_per_doc`` runs of 64 bytes at spread places of each; documents without a
    label, an id or a letter are not used. Hashes below a threshold for each language's count are read, so nothing is ranked
    or shuffled but the sample.
    """
    rows = only(small_batches(docs), {"doc_id": "long", "text": "string", "lang": "string"}).where(
        F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    counts = rows.groupBy("lang").agg(F.count("*").alias("docs")).orderBy(F.desc("docs"), "lang").limit(MOST_LANGUAGES)
    # Twice as many as are needed: some have no letter, and hashes don't fall evenly.
    share = F.least(F.lit(1.0), F.lit(2.0 * docs_per_language) / F.col("docs"))
    shares = F.broadcast(counts.select("lang", (share * 2.0 ** 62).cast("long").alias("below")))
    order = F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 2)
    sample = rows.join(shares, "lang").withColumn("order", order).where((F.col("order") <= F.col("below")) & _has_letter(F.col("text")))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = raw(batch.column("text"))
            langs, out, ids = [], [], []
            for k, (name, lang) in enumerate(zip(batch.column("order").to_pylist(), batch.column("lang").to_pylist(), strict=True)):
                text = data[offsets[k]:offsets[k + 1]]
                count = min(runs_per_doc, -(-len(text) // RUN))
                for i in range(count):
                    at = i * (len(text) - RUN) // max(count - 1, 1)
                    part = np.resize(text, RUN) if len(text) < RUN else text[at:at + RUN]  # a short text repeats
                    langs.append(lang)
                    ids.append(name)
                    out.append(part.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(ids, pa.int64()), pa.array(out, pa.binary())],
                                             names=["lang", "order", "run"])

    found = sample.select("order", "lang", "text").mapInArrow(cut, "lang string, order long, run binary").distinct()
    taken = found.toPandas().sort_values(["lang", "order", "run"])
    # Equal documents count once; of the others the first by hash are used.
    place = taken.groupby("lang")["order"].rank(method="dense")
    taken = taken[place <= docs_per_language]
    languages = sorted(taken["lang"].unique())
    if not languages:
        return new_model([])
    runs = np.frombuffer(b"".join(taken["run"]), np.uint8).reshape(-1, RUN)
    return train(languages, runs, np.searchsorted(languages, taken["lang"].to_numpy()), steps)


def least_score(found: DataFrame, folds: int = FOLDS) -> float:
    """The score that an answer needs to be believed, from documents that were held out (``doc_id``, ``text``, ``lang``,
    ``lang_pred``, ``score``): somewhat below the lowest thousandth of the right answers. 0 if there are fewer than ``EVIDENCE``.

    Texts under ``JUDGED_BYTES`` say too little and are not asked.
    """
    right = (remainder(F.col("doc_id"), folds) == 0) & (F.col("lang") == F.col("lang_pred")) & (F.octet_length("text") >= JUDGED_BYTES)
    low, count = found.where(right).agg(F.percentile_approx("score", 0.001, 10_000), F.count("*")).first()
    return SCORE_MARGIN * low if count >= EVIDENCE else 0.0


def believable(least: float) -> Column:
    """Whether a text has a letter and, if it is long enough to tell, a score of at least ``least``."""
    return _has_letter(F.col("text")) & ((F.col("score") >= least) | (F.octet_length("text") < JUDGED_BYTES))


def _has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def strange(model: Model, data: np.ndarray) -> np.ndarray:
    """The bytes of characters beyond ASCII that no training run holds: what the network says of them is not learned."""
    later = (data & 0xC0) == 0x80
    out = np.zeros(len(data), bool)
    out[1:] = later[1:] & ~model.pairs[data[:-1].astype(np.uint16) << 8 | data[1:]]
    out[:-1] |= out[1:] & ~later[:-1]
    return out


def predict(model: Model, data: np.ndarray, offsets: np.ndarray, learned: bool = False) -> np.ndarray:
    """Mean probabilities (document, language) over all bytes of each text; zeros for empty texts. With ``learned``,
    the probabilities at strange bytes count as zeros."""
    sizes = np.diff(offsets)
    counts = -(-sizes // RUN)
    owner = np.repeat(np.arange(len(sizes)), counts)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    starts = offsets[:-1][owner] + place * RUN
    lengths = np.minimum(RUN, offsets[1:][owner] - starts)
    unknown = offsets[0] + np.flatnonzero(strange(model, data[offsets[0]:offsets[-1]])) if learned else offsets[:0]
    sums = np.zeros((len(sizes), len(model.languages)))
    for at in range(0, len(owner), 2048):
        low, size = starts[at:at + 2048], lengths[at:at + 2048]
        places = np.minimum(low[None, :] + np.arange(RUN)[:, None], len(data) - 1)
        runs = data[places].astype(np.intp)
        found = position_probabilities(model, runs, size)
        counted = np.arange(RUN)[:, None] < size
        if len(unknown):
            near = np.searchsorted(unknown, places)
            counted &= unknown[np.minimum(near, len(unknown) - 1)] != places
        found *= counted[:, None, :]
        np.add.at(sums, owner[at:at + 2048], found.sum(axis=0).T)
    return sums / np.maximum(sizes, 1)[:, None]


def identify(docs: DataFrame, model: Model, keep: tuple[str, ...] = (), learned: bool = False) -> DataFrame:
    """Documents (``doc_id``, ``text``) with ``lang_pred`` and ``score``, the mean probability of that language; columns named
    in ``keep`` are handed on behind them. With ``learned``, characters that the training runs don't hold add nothing to it.

    A missing text, or one without a letter, is ``und`` with score 0, and so is every text if the model knows no language.
    Of equal probabilities the first language by name wins. Every row is answered by its text alone, repeated and missing
    ids too; an empty table gives no rows; other columns are ignored.
    """
    docs = small_batches(docs)
    others = docs.select(*[F.col(f"`{name}`") for name in keep]).schema
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       *[F.col(f"`{name}`").alias(f"kept {name}") for name in keep]).withColumn("letters", _has_letter(F.col("text")))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            data, offsets = raw(batch.column("text"))
            letters = batch.column("letters").to_numpy(zero_copy_only=False)
            for start, stop in slices(batch.column("text")):
                n = stop - start
                known = letters[start:stop] & bool(model.languages)
                names, scores = np.full(n, UNDECIDED, object), np.zeros(n)
                if known.any():
                    found = predict(model, data, offsets[start:stop + 1], learned)
                    best = found.argmax(axis=1)
                    names[known] = np.array(model.languages, object)[best[known]]
                    scores[known] = np.clip(found[np.arange(n), best][known], 0, 1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(start, n), pa.array(names, pa.string()), pa.array(scores),
                     *(batch.column(f"kept {name}").slice(start, n) for name in keep)],
                    names=["doc_id", "lang_pred", "score", *keep])

        give_back()

    fields = schema("doc_id long, lang_pred string, score double").fields
    return rows.mapInArrow(label, T.StructType([*fields, *others.fields]))
