"""Language identification by a bidirectional gated recurrent network over bytes.

One network reads each run of bytes forwards and one backwards; from both states
every position gets a label distribution, and a document's is the mean over all
its positions. The network is small, trained on the driver by backpropagation
through time from a bounded sample, and applied to every byte of every text.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matchstrata.llm.tokens import trim
from matchstrata.session import stage

UNKNOWN = "und"
HIDDEN = 8
#: Labelled documents used for training (one of each language at least, whatever their number),
#: and the characters taken from each.
SAMPLE_DOCS = 1_600
SAMPLE_CHARS = 600
TRAIN_RUN = 48
TRAIN_BATCH = 160
TRAIN_STEPS = 260
RATE = 0.02
SEED = 20_240_501
RUN = 128  # bytes read in one go when predicting; longer texts are several runs
RUNS_AT_ONCE = 1_024
LEAST_SCORE = 0.4
_HASHES = 1 << 30

_PAD = 256
_LETTER = re.compile(r"[A-Za-z]")


def held_out(doc_id: str = "doc_id"):
    """Documents that are never learnt from: crc32 of the id as text leaves 2, divided by 4."""
    return F.coalesce(F.crc32(F.encode(F.col(doc_id).cast("string"), "UTF-8")) % 4 == 2, F.lit(False))


@dataclass
class Network:
    """Weights of both directions, stacked: 0 forwards, 1 backwards. Gates in the order z, r, n."""

    languages: list[str]
    inputs: np.ndarray  # 2 x 257 x 3H, biases included
    states: np.ndarray  # 2 x H x 3H
    out: np.ndarray  # 2 x H x L
    bias: np.ndarray  # L

    def parts(self) -> list[np.ndarray]:
        return [self.inputs, self.states, self.out, self.bias]


def _gate(x: np.ndarray) -> np.ndarray:
    """Piecewise linear sigmoid."""
    return np.clip(0.25 * x + 0.5, 0, 1)


def _both_ways(runs: np.ndarray) -> np.ndarray:
    return np.stack([runs, runs[:, ::-1]])


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def loss_and_gradients(net: Network, runs: np.ndarray, labels: np.ndarray):
    """Mean cross-entropy over all positions, and its gradients by backpropagation through time."""
    n, steps = runs.shape
    h_size = net.states.shape[1]
    both = _both_ways(runs)
    side = np.arange(2)[:, None]
    h = np.zeros((2, n, h_size))
    kept = []
    for t in range(steps):
        a = net.inputs[side, both[:, :, t]]
        b = h @ net.states
        z = _gate(a[..., :h_size] + b[..., :h_size])
        r = _gate(a[..., h_size : 2 * h_size] + b[..., h_size : 2 * h_size])
        c = np.tanh(a[..., 2 * h_size :] + r * b[..., 2 * h_size :])
        kept.append((h, z, r, c, b[..., 2 * h_size :]))
        h = c + z * (h - c)
    after = [k[0] for k in kept[1:]] + [h]
    forward = np.stack([x[0] for x in after])  # position by row
    backward = np.stack([x[1] for x in after])[::-1]
    p = _softmax(forward @ net.out[0] + backward @ net.out[1] + net.bias)
    truth = np.eye(len(net.languages))[labels][None]
    loss = -np.log(np.maximum((p * truth).sum(-1), 1e-12)).mean()
    d = (p - truth) / (n * steps)
    flat = d.reshape(-1, d.shape[-1])
    d_out = np.stack([x.reshape(-1, h_size).T @ flat for x in (forward, backward)])
    d_state = np.stack([d @ net.out[0].T, (d @ net.out[1].T)[::-1]], axis=1)  # step, side, row, unit
    d_inputs, d_states = np.zeros_like(net.inputs), np.zeros_like(net.states)
    d_h = np.zeros_like(h)
    for t in range(steps - 1, -1, -1):
        before, z, r, c, b_n = kept[t]
        d_new = d_h + d_state[t]
        d_c = d_new * (1 - z) * (1 - c * c)
        d_z = d_new * (before - c) * 0.25 * ((z > 0) & (z < 1))
        d_r = d_c * b_n * 0.25 * ((r > 0) & (r < 1))
        d_b = np.concatenate([d_z, d_r, d_c * r], axis=-1)
        d_h = d_new * z + d_b @ net.states.transpose(0, 2, 1)
        d_states += before.transpose(0, 2, 1) @ d_b
        np.add.at(d_inputs, (side, both[:, :, t]), np.concatenate([d_z, d_r, d_c], axis=-1))
    return loss, [d_inputs, d_states, d_out, flat.sum(axis=0)]


def new_network(languages: list[str], rng: np.random.Generator, hidden: int = HIDDEN) -> Network:
    return Network(
        languages,
        rng.normal(0, 0.3, (2, _PAD + 1, 3 * hidden)),
        rng.normal(0, 0.4 / np.sqrt(hidden), (2, hidden, 3 * hidden)),
        rng.normal(0, 0.3, (2, hidden, len(languages))),
        np.zeros(len(languages)),
    )


def train(samples: list[tuple[bytes, str]], steps: int = TRAIN_STEPS, seed: int = SEED) -> Network:
    """Adam on random runs of the samples, all languages equally often.

    The labels go round from step to step, so languages beyond the size of a batch
    take part too; the steps grow with their number.
    """
    rng = np.random.default_rng(seed)
    languages = sorted({lang for _, lang in samples})
    net = new_network(languages, rng)
    texts = [[np.frombuffer(raw, np.uint8) for raw, lang in samples if lang == one and raw] for one in languages]
    first, second = [np.zeros_like(p) for p in net.parts()], [np.zeros_like(p) for p in net.parts()]
    steps = max(steps, -(-steps * len(languages) // TRAIN_BATCH))
    for step in range(1, steps + 1):
        labels = ((step - 1) * TRAIN_BATCH + np.arange(TRAIN_BATCH)) % len(languages)
        runs = np.full((TRAIN_BATCH, TRAIN_RUN), _PAD, np.int64)
        for k, label in enumerate(labels):
            raw = texts[label][rng.integers(len(texts[label]))]
            at = rng.integers(max(1, len(raw) - TRAIN_RUN + 1))
            part = raw[at : at + TRAIN_RUN]
            runs[k, : len(part)] = part
        _, gradients = loss_and_gradients(net, runs, labels)
        rate = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
        for p, g, m, v in zip(net.parts(), gradients, first, second, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return net


class Reader:
    """The trained network over many runs at once, in single precision."""

    def __init__(self, net: Network):
        h = net.states.shape[1]
        scale = np.concatenate([np.full(2 * h, 0.25), np.ones(h)])  # the gates' slope, folded into the weights
        shift = np.concatenate([np.full(2 * h, 0.5), np.zeros(h)])
        self.h, self.languages = h, net.languages
        self.inputs = (net.inputs * scale + shift).astype(np.float32)
        self.states = (net.states * scale).astype(np.float32)
        self.out, self.bias = net.out.astype(np.float32), net.bias.astype(np.float32)

    def _one_way(self, columns: np.ndarray, side: int) -> np.ndarray:
        """States after each of the steps; ``columns`` holds a step by row."""
        h_size, (steps, n) = self.h, columns.shape
        inputs, states = self.inputs[side], self.states[side]
        out = np.empty((steps, n, h_size), np.float32)
        a, b = np.empty((n, 3 * h_size), np.float32), np.empty((n, 3 * h_size), np.float32)
        gates, c = np.empty((n, 2 * h_size), np.float32), np.empty((n, h_size), np.float32)
        h = np.zeros((n, h_size), np.float32)
        for t in range(steps):
            np.take(inputs, columns[t], axis=0, out=a, mode="clip")
            np.matmul(h, states, out=b)
            np.add(a[:, : 2 * h_size], b[:, : 2 * h_size], out=gates)
            np.clip(gates, 0, 1, out=gates)
            np.multiply(gates[:, h_size:], b[:, 2 * h_size :], out=c)
            c += a[:, 2 * h_size :]
            np.tanh(c, out=c)
            new = out[t]
            np.subtract(h, c, out=new)
            new *= gates[:, :h_size]
            new += c
            h = new
        return out

    def positions(self, runs: np.ndarray, lengths: np.ndarray | None = None) -> np.ndarray:
        """Label distribution of every position of every run: run, position, language.

        A run may be shorter than the others, with anything behind it: the backward
        reading starts at its own end, so it does not depend on its neighbours.
        """
        columns = np.ascontiguousarray(runs.T)
        steps, n = columns.shape
        turned = None
        if lengths is not None and (lengths != steps).any():
            turned = (lengths[None, :] - 1 - np.arange(steps)[:, None]) % steps, np.arange(n)[None, :]
        forward = self._one_way(columns, 0)
        scores = forward.reshape(-1, self.h) @ self.out[0]
        del forward
        backward = self._one_way(columns[::-1] if turned is None else columns[turned], 1)
        back = (backward.reshape(-1, self.h) @ self.out[1]).reshape(steps, n, -1)
        del backward
        scores += (back[::-1] if turned is None else back[turned]).reshape(steps * n, -1)
        scores += self.bias
        scores -= scores.max(axis=1, keepdims=True)
        np.exp(scores, out=scores)
        scores /= scores.sum(axis=1, keepdims=True)
        return scores.reshape(steps, n, -1).transpose(1, 0, 2)

    def pooled(self, texts: list[bytes]) -> np.ndarray:
        """Mean distribution over all positions of each text; zeros for an empty text."""
        sizes = np.array([len(t) for t in texts], np.int64)
        total = np.zeros((len(texts), len(self.languages)))
        n_runs = -(-sizes // RUN)
        owner = np.repeat(np.arange(len(texts)), n_runs)
        flat = np.frombuffer(b"".join(texts), np.uint8)
        starts = np.concatenate([[0], np.cumsum(sizes)])[:-1]
        place = np.arange(len(owner)) - np.repeat(np.cumsum(n_runs) - n_runs, n_runs)
        begin = starts[owner] + RUN * place
        length = np.minimum(RUN, sizes[owner] - RUN * place)
        # Runs of like length together: the pads behind short ones then stay few.
        by_length = np.argsort(length, kind="stable")
        for k in range(0, len(owner), RUNS_AT_ONCE):
            some = by_length[k : k + RUNS_AT_ONCE]
            width = int(length[some].max())
            inside = np.arange(width)[None, :] < length[some, None]
            at = np.minimum(begin[some, None] + np.arange(width)[None, :], len(flat) - 1)
            runs = np.where(inside, flat[at], _PAD).astype(np.int64)
            p = self.positions(runs, length[some])
            sums = np.einsum("ntl,nt->nl", p, inside.astype(np.float32))
            np.add.at(total, owner[some], sums)
        return total / np.maximum(sizes, 1)[:, None]


def has_letter(text: str | None) -> bool:
    return bool(text) and bool(_LETTER.search(text) or any(map(str.isalpha, text)))


def sample_of(docs: DataFrame, lang: str = "lang") -> list[tuple[bytes, str]]:
    """``SAMPLE_DOCS`` labelled documents that are not held out, evenly over languages, each with one at least.

    Ids are chosen by hash from all rows, without their texts; then a part of
    ``SAMPLE_CHARS`` characters, at a place by hash, of each chosen text is read.
    """
    docs = docs.select("doc_id", F.col(lang).alias("lang"), "text").where("lang IS NOT NULL")
    can = docs.where(F.col("doc_id").isNotNull() & ~held_out()).select(
        "doc_id", "lang", F.pmod(F.xxhash64("doc_id"), F.lit(_HASHES)).alias("hash")
    )
    counts = can.groupBy("lang").agg(F.count("*").alias("n"))
    languages = [(r["lang"], r["n"]) for r in counts.orderBy(F.desc("n"), "lang").collect()]  # the labels to learn
    if not languages:
        return []
    each = max(1, SAMPLE_DOCS // len(languages))
    # The least hashes of a language lie below this, so what meets in one task stays about as small as the sample.
    below = F.create_map(*[F.lit(x) for lang_, n in languages for x in (lang_, min(_HASHES, 1 + _HASHES * 4 * (each + 16) // n))])
    order = Window.partitionBy("lang").orderBy("hash", "doc_id")
    ids = can.where(F.col("hash") < below[F.col("lang")]).withColumn("n", F.row_number().over(order))
    ids = ids.where(F.col("n") <= each).select(F.col("doc_id").alias("__id")).distinct()
    sampled = stage(ids, "language-sample")
    ids = sampled.df
    start = F.pmod(F.xxhash64("doc_id", F.lit("part")), F.greatest(F.char_length("text") - SAMPLE_CHARS + 1, F.lit(1))) + 1
    rows = (
        docs.where(F.col("text").isNotNull())
        .join(ids, docs["doc_id"] == F.col("__id"), "left_semi")
        .select("doc_id", "lang", F.substring("text", start.cast("int"), F.lit(SAMPLE_CHARS)).alias("part"))
        .orderBy("doc_id", "lang", "part")
        .limit(2 * each * len(languages))
        .collect()
    )
    sampled.discard()
    return [(r["part"].encode(), r["lang"]) for r in rows if has_letter(r["part"])]


def languages_of(docs: DataFrame, net: Network | None) -> DataFrame:
    """Per document: ``doc_id, lang_pred, score``.

    ``score`` is the pooled probability of ``lang_pred``. A text that is null or
    has no letter is ``und`` with score 0, and so is every text if there was
    nothing to learn from. Rows with null or repeated ids all get a result.
    """
    weights = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches):
        reader = Reader(weights.value) if weights.value else None
        for batch in batches:
            for begin in range(0, batch.num_rows, 512):
                part = batch.slice(begin, 512)
                texts = part.column(1).to_pylist()
                lettered = [reader is not None and has_letter(t) for t in texts]
                names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
                asked = [k for k, ok in enumerate(lettered) if ok]
                if asked:
                    p = reader.pooled([texts[k].encode() for k in asked])
                    for k, row in zip(asked, p, strict=True):
                        best = int(row.argmax())
                        names[k], scores[k] = reader.languages[best], min(1.0, max(0.0, float(row[best])))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(names), pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"]
                )
        trim()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double")


def identified(docs: DataFrame) -> DataFrame:
    """Train on ``docs``, then predict all of them: ``doc_id, held_out, lang_pred, score``."""
    samples = sample_of(docs)
    found = languages_of(docs, train(samples) if samples else None)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def in_known_language(docs: DataFrame, least: float = LEAST_SCORE) -> DataFrame:
    """``docs`` without those that get no language, or one with a score below ``least``.

    The prediction runs beside the row, so ids may be null or repeat. Where
    nothing is labelled nothing can be judged, and all documents stay.
    """
    samples = sample_of(docs)
    if not samples:
        return docs
    weights = docs.sparkSession.sparkContext.broadcast(train(samples))
    text_at = docs.columns.index("text")

    def run(batches):
        reader = Reader(weights.value)
        for batch in batches:
            for begin in range(0, batch.num_rows, 512):
                part = batch.slice(begin, 512)
                texts = [t.encode() if has_letter(t) else b"" for t in part.column(text_at).to_pylist()]
                best = reader.pooled(texts).max(axis=1) if any(texts) else np.zeros(len(texts))
                yield part.filter(pa.array([bool(t) and bool(p >= least) for t, p in zip(texts, best, strict=True)]))
        trim()

    return docs.mapInArrow(run, docs.schema)
