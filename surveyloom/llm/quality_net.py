"""Quality classifier: a byte-level convolutional network in numpy.

Bytes are embedded; filters of WIDTH bytes run over chunks that overlap by half and cover the whole text;
each filter keeps its largest response, and a logistic layer combines them into one probability. For
scoring, embedding and filters fold into one table per place in the chunk, so a response is a sum of
looked-up rows. Training follows the gradient through the largest responses only.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, keyed, texts_of

WIDTH, STRIDE, EMBEDDING, FILTERS = 8, 4, 8, 24
#: Labelled rows of either class that are learned from, drawn by hash, and the bytes of their whole texts together.
ROWS_PER_CLASS, CLASS_BYTES = 2000, 16 << 20
EPOCHS, BATCH, RATE, SHRINK = 12, 32, 0.01, 1e-4
THRESHOLD = 0.3
AT_ONCE = 1 << 20


class Net:
    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        self.embedding = r.normal(0, 0.5, (256, EMBEDDING)).astype(np.float32)
        self.filters = r.normal(0, 1 / np.sqrt(WIDTH * EMBEDDING), (WIDTH, EMBEDDING, FILTERS)).astype(np.float32)
        self.shift = np.zeros(FILTERS, np.float32)
        self.weights = r.normal(0, 0.3, FILTERS).astype(np.float32)
        self.bias = np.zeros(1, np.float32)

    @property
    def parameters(self):
        return [self.embedding, self.filters, self.shift, self.weights, self.bias]

    def fold(self) -> "Net":
        self.table = np.einsum("be,wef->wbf", self.embedding, self.filters).astype(np.float32)
        return self

    @staticmethod
    def chunks(texts: list[bytes]):
        """Padded bytes of all texts, chunk starts, and each text's first chunk; an empty text has one chunk of padding."""
        size = np.array([len(t) for t in texts], np.int64)
        count = np.maximum(1, -(-(size - WIDTH) // STRIDE) + 1)
        room = (count - 1) * STRIDE + WIDTH
        data = np.frombuffer(b"".join(t.ljust(n, b"\0") for t, n in zip(texts, room.tolist())), np.uint8)
        first = np.cumsum(count) - count
        start = np.repeat(np.cumsum(room) - room, count) + STRIDE * (np.arange(count.sum()) - np.repeat(first, count))
        return data, start, first

    def responses(self, data: np.ndarray, start: np.ndarray) -> np.ndarray:
        out = self.table[0][data[start]]
        for w in range(1, WIDTH):
            out += self.table[w][data[start + w]]
        return out

    def probability(self, texts: list[bytes]) -> np.ndarray:
        """Probabilities of whole texts; a long text runs in pieces that overlap by a chunk, its responses are maxima over all."""
        pooled = np.full((len(texts), FILTERS), -np.inf, np.float32)
        group, owners, size = [], [], 0

        def run():
            data, start, first = self.chunks(group)
            np.maximum.at(pooled, owners, np.maximum.reduceat(self.responses(data, start), first))

        for k, text in enumerate(texts):
            for at in range(0, max(1, len(text) - WIDTH + STRIDE), AT_ONCE):
                group.append(text[at:at + AT_ONCE + WIDTH - STRIDE])
                owners.append(k)
                size += len(group[-1])
                if size >= AT_ONCE:
                    run()
                    group, owners, size = [], [], 0
        if group:
            run()
        z = np.maximum(pooled + self.shift, 0).astype(np.float64) @ self.weights + self.bias[0]
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))

    def peaks(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Of every text and filter the largest response, and the WIDTH bytes that give it (the first of equal ones)."""
        top = np.full((len(texts), FILTERS), -np.inf, np.float32)
        window = np.zeros((len(texts), FILTERS, WIDTH), np.uint8)
        offsets = np.arange(WIDTH)
        for k, text in enumerate(texts):
            for at in range(0, max(1, len(text) - WIDTH + STRIDE), AT_ONCE):
                data, start, _ = self.chunks([text[at:at + AT_ONCE + WIDTH - STRIDE]])
                response = self.responses(data, start)
                best = response.argmax(0)
                value = response[best, np.arange(FILTERS)]
                new = value > top[k]
                top[k, new] = value[new]
                window[k, new] = data[start[best][new, None] + offsets]
        return top, window

    def gradients(self, texts: list[bytes], labels: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
        """Of the weighted log loss, in the order of ``parameters``; it runs back through the largest responses only."""
        top, window = self.fold().peaks(texts)
        pooled = top + self.shift
        active = np.maximum(pooled, 0)
        p = 1 / (1 + np.exp(-np.clip(active @ self.weights + self.bias[0], -50, 50)))
        slope = ((p - labels) * weight).astype(np.float32)
        back = slope[:, None] * self.weights * (pooled > 0)
        d_embedding, d_filters = np.zeros_like(self.embedding), np.zeros_like(self.filters)
        for w in range(WIDTH):
            byte = window[:, :, w]
            d_filters[w] = np.einsum("nf,nfe->ef", back, self.embedding[byte])
            np.add.at(d_embedding, byte, back[:, :, None] * self.filters[w].T[None])
        return [d_embedding, d_filters, back.sum(0), slope @ active, slope.sum(keepdims=True)]

    def fit(self, texts: list[bytes], labels: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> "Net":
        r = np.random.default_rng(seed)
        first_moment = [np.zeros_like(p) for p in self.parameters]
        second_moment = [np.zeros_like(p) for p in self.parameters]
        share = np.clip(labels.mean(), 0.01, 0.99)
        step = 0
        for _ in range(epochs):
            order = r.permutation(len(texts))
            for at in range(0, len(order), BATCH):
                rows = order[at:at + BATCH]
                y = labels[rows]
                gradients = self.gradients([texts[i] for i in rows], y, np.where(y == 1, 0.5 / share, 0.5 / (1 - share)) / len(rows))
                step += 1
                for k, (p_, g) in enumerate(zip(self.parameters, gradients)):
                    g = g + SHRINK * p_
                    first_moment[k] = 0.9 * first_moment[k] + 0.1 * g
                    second_moment[k] = 0.999 * second_moment[k] + 0.001 * g * g
                    p_ -= RATE * (first_moment[k] / (1 - 0.9**step)) / (np.sqrt(second_moment[k] / (1 - 0.999**step)) + 1e-8)
        return self.fold()


def training_rows(docs: DataFrame, labels: DataFrame, label_col: str, modulus: int, remainder: int, per_class: int, class_bytes: int, id_col: str, text_col: str):
    """(text, label) of about ``per_class`` rows of either class with whole texts; only ids of that bounded sample are broadcast.

    Rows are taken by the hash of their id as long as their texts are ``class_bytes`` together: the texts of
    one class that reach the driver stay below that. A row that does not fit is passed over, not cut.
    """
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(F.col(id_col), modulus, remainder))
    known = known.groupBy(F.col(id_col).cast("long").alias("__id")).agg(F.min(F.col(label_col).cast("int")).alias("__label"))
    sizes = {r["__label"]: r["count"] for r in known.groupBy("__label").count().collect()}
    if not sizes:
        return []
    share = F.create_map(*[F.lit(x) for k, v in sizes.items() for x in (k, int(min(1.0, per_class / v) * (1 << 30)))])
    chosen = known.where(F.pmod(F.xxhash64("__id"), F.lit(1 << 30)) < share[F.col("__label")])
    text = F.col(text_col).cast("string")
    drawn = docs.where(F.col(text_col).isNotNull()).join(F.broadcast(chosen), F.col(id_col).cast("long") == F.col("__id")).select(
        "__id", "__label", text.alias("__text"), F.octet_length(text).alias("__bytes"), F.xxhash64(text).alias("__tag"))
    fitting = drawn.where(F.col("__bytes") <= class_bytes)
    room, taken = {0: class_bytes, 1: class_bytes}, []
    for r in fitting.select("__id", "__label", "__tag", "__bytes").distinct().orderBy(F.xxhash64("__id"), "__id", "__tag").collect():
        if r["__bytes"] <= room[r["__label"]]:
            room[r["__label"]] -= r["__bytes"]
            taken.append((r["__id"], r["__tag"]))
    if not taken:
        return []
    picked = docs.sparkSession.createDataFrame(taken, "__id long, __tag long")
    rows = fitting.join(F.broadcast(picked), ["__id", "__tag"]).select("__id", "__text", "__label").distinct()
    return sorted((r["__id"], r["__text"].encode(), r["__label"]) for r in rows.collect())


def score(docs: DataFrame, labels: DataFrame, label_col: str = "quality", modulus: int = 5, remainder: int = 0, per_class: int = ROWS_PER_CLASS, class_bytes: int = CLASS_BYTES,
          threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, tag, held_out, score (probability of label 1), predicted.

    Rows with crc32(doc_id) modulo ``modulus`` equal to ``remainder`` are held out of training; only
    bytes of the text are inputs. Null texts are empty; an empty text is a chunk of padding. Repeated
    labels of an id count as its smallest. Without labelled rows every score is 0.5; with one class
    only, the network learns that class.
    """
    spark = docs.sparkSession
    sample = training_rows(docs, labels, label_col, modulus, remainder, per_class, class_bytes, id_col, text_col)
    net = Net().fit([t for _, t, _ in sample], np.array([y for _, _, y in sample], np.float32)) if sample else None
    shared = spark.sparkContext.broadcast(net)

    def run(batches):
        for batch in batches:
            texts = texts_of(batch.column("text"))
            p = shared.value.probability(texts) if shared.value is not None and texts else np.full(len(texts), 0.5)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("tag"), pa.array(p, pa.float64()), pa.array((p >= threshold).astype(np.int32))], ["doc_id", "tag", "score", "predicted"])

    found = keyed(docs, id_col, text_col).mapInArrow(run, "doc_id long, tag long, score double, predicted int")
    return found.select("doc_id", "tag", held_out(F.col("doc_id"), modulus, remainder).alias("held_out"), "score", "predicted")
