"""Language identification by a bidirectional gated recurrent network over bytes, trained in NumPy."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.llm import words as W
from tallyframe.llm.base import among_first, bounded_broadcast, saved

HIDDEN = 6
SPAN = 64  # bytes that the network reads at once; a text is cut into as many spans as it needs
SAMPLE = 96  # documents per language that it learns from
SPANS = 8  # of each of these, so many evenly spaced spans
BROADCAST_LANGUAGES = 10_000
BATCH = 128
STEPS = 300
RATE = 0.02
UNKNOWN = "und"
_AT_ONCE = 4096  # spans in one batch of a prediction


@dataclass
class Network:
    """Weights by name: per direction ``x`` (bytes to gates), ``u`` (state to gates), ``o`` (state to languages), and the bias ``b``."""

    languages: list[str]
    weights: dict[str, np.ndarray]


def _step(x: np.ndarray, h: np.ndarray, u: np.ndarray) -> tuple[np.ndarray, ...]:
    """One step of the gated unit: update gate z, reset gate r, candidate n. ``x`` are the gates' inputs from the byte."""
    size = h.shape[1]
    from_h = h @ u
    gates = x[:, : 2 * size] + from_h[:, : 2 * size]
    gates *= 0.5
    np.tanh(gates, out=gates)
    gates += 1
    gates *= 0.5
    z, r = gates[:, :size], gates[:, size:]
    n = from_h[:, 2 * size :] * r
    n += x[:, 2 * size :]
    np.tanh(n, out=n)
    new = h - n
    new *= z
    new += n
    return new, z, r, n, from_h[:, 2 * size :]


def _states(bytes_: np.ndarray, weights: dict[str, np.ndarray], way: str, keep: list | None = None) -> np.ndarray:
    """States after each byte, for bytes (time, spans); direction ``b`` runs from the end."""
    steps, many = bytes_.shape
    x, u = weights["x" + way], weights["u" + way]
    out = np.empty((steps, many, u.shape[0]), np.float32)
    h = np.zeros((many, u.shape[0]), np.float32)
    for t in range(steps) if way == "f" else range(steps - 1, -1, -1):
        before = h
        h, z, r, n, un = _step(x[bytes_[t]], h, u)
        out[t] = h
        if keep is not None:
            keep.append((t, before, z, r, n, un))
    return out


def probabilities(bytes_: np.ndarray, weights: dict[str, np.ndarray], kept: dict[str, list] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Probability of each language at each position (time, spans, languages), and the states of both directions."""
    states = [_states(bytes_, weights, way, None if kept is None else kept.setdefault(way, [])) for way in "fb"]
    logits = states[0] @ weights["of"] + states[1] @ weights["ob"] + weights["b"]
    logits -= logits.max(axis=2, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=2, keepdims=True)
    return logits, *states


def gradients(bytes_: np.ndarray, valid: np.ndarray, label: np.ndarray, weights: dict[str, np.ndarray]) -> tuple[float, dict[str, np.ndarray]]:
    """Mean cross-entropy over valid positions and its gradient by backpropagation through time."""
    kept: dict[str, list] = {}
    p, *states = probabilities(bytes_, weights, kept)
    total = max(int(valid.sum()), 1)
    right = np.take_along_axis(p, np.broadcast_to(label[None, :, None], (*bytes_.shape, 1)), 2)[..., 0]
    loss = -float((np.log(np.maximum(right, 1e-9)) * valid).sum()) / total
    d = p.copy()
    d[:, np.arange(len(label)), label] -= 1
    d *= (valid / total)[..., None].astype(np.float32)
    grads = {"b": d.sum(axis=(0, 1))}
    for way, state in zip("fb", states):
        u, o = weights["u" + way], weights["o" + way]
        size = u.shape[0]
        grads["o" + way] = np.tensordot(state, d, ([0, 1], [0, 1]))
        into = d @ o.T
        gu, gx = np.zeros_like(u), np.zeros_like(weights["x" + way])
        dh = np.zeros((bytes_.shape[1], size), np.float32)
        for t, before, z, r, n, un in reversed(kept[way]):
            dh = dh + into[t]
            dn = dh * (1 - z) * (1 - n * n)
            dz = dh * (before - n) * z * (1 - z)
            dr = dn * un * r * (1 - r)
            da = np.concatenate([dz, dr, dn * r], axis=1)
            gu += before.T @ da
            np.add.at(gx, bytes_[t], np.concatenate([dz, dr, dn], axis=1))
            dh = dh * z + da @ u.T
        grads["u" + way], grads["x" + way] = gu, gx
    return loss, grads


def fitted(spans: np.ndarray, valid: np.ndarray, label: np.ndarray, languages: list[str], hidden: int = HIDDEN, steps: int = STEPS, seed: int = 5) -> Network:
    """Network fitted with Adam on spans (bytes, time). The same spans in the same order give the same network."""
    rng = np.random.default_rng(seed)
    normal = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
    weights = {"b": np.zeros(len(languages), np.float32)}
    for way in "fb":
        weights["x" + way] = normal(256, 3 * hidden, scale=0.3)
        weights["u" + way] = normal(hidden, 3 * hidden, scale=hidden**-0.5)
        weights["o" + way] = normal(hidden, len(languages), scale=hidden**-0.5)
    mean, square = ({k: np.zeros_like(w) for k, w in weights.items()} for _ in range(2))
    for i in range(1, steps + 1 if len(spans) else 1):
        pick = rng.integers(0, len(spans), min(BATCH, len(spans)))
        _, grads = gradients(spans[pick].T.copy(), valid[pick].T, label[pick], weights)
        norm = float(np.sqrt(sum(float((g * g).sum()) for g in grads.values())))
        rate = RATE * min(1.0, 3 * (1 - i / (steps + 1)))
        for k, g in grads.items():
            g = g * min(1.0, 1.0 / max(norm, 1e-9))
            mean[k] += 0.1 * (g - mean[k])
            square[k] += 0.01 * (g * g - square[k])
            weights[k] -= (rate * (mean[k] / (1 - 0.9**i)) / (np.sqrt(square[k] / (1 - 0.99**i)) + 1e-8)).astype(np.float32)
    return Network(languages, weights)


def held_out(doc_id: Column) -> Column:
    """Documents that nothing is learned from: crc32 of the id as text leaves 1 when divided by 3. A null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def _has_letter(texts: pa.Array) -> np.ndarray:
    return np.asarray(pc.match_substring_regex(texts, r"\p{L}")).astype(bool)


def _span_table(sizes: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For texts of the given sizes: first byte, length and text number of each span."""
    count = -(-sizes // SPAN)
    text = np.repeat(np.arange(len(sizes)), count)
    step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    return begin[text] + step * SPAN, np.minimum(SPAN, sizes[text] - step * SPAN), text


def learned(docs: DataFrame, sample: int = SAMPLE, hidden: int = HIDDEN, steps: int = STEPS) -> Network:
    """Network learned from at most ``sample`` documents of each language, those with the least hashed ids, and ``SPANS`` spans of each."""
    rows = docs.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.col("lang") != UNKNOWN))
    key = F.xxhash64("doc_id", F.lit(10))
    order = Window.partitionBy("lang").orderBy(key, "doc_id")
    sizes = saved(rows.groupBy("lang").agg(F.count("*").alias("rows")).withColumnRenamed("lang", "language"), "languages")
    counted = rows.select("doc_id", "lang").join(bounded_broadcast(sizes, BROADCAST_LANGUAGES), F.col("lang") == F.col("language"))
    few = counted.where(among_first(key, sample, F.col("rows"))).select("doc_id", "lang")
    ids = few.withColumn("place", F.row_number().over(order)).where(F.col("place") <= sample)
    ids = saved(ids.select(F.col("doc_id").alias("id"), F.col("lang").alias("language")), "sample").distinct()
    picked = rows.select("doc_id", "lang", "text").join(bounded_broadcast(ids, 1_000_000), F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("lang") == F.col("language")))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, lang, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                data = text.encode()
                count = -(-len(data) // SPAN)
                for k in sorted({i * max(count - 1, 0) // (SPANS - 1) for i in range(SPANS)}):
                    if any(map(str.isalpha, data[k * SPAN : k * SPAN + SPAN].decode(errors="ignore"))):
                        out.append((doc_id or 0, lang, k, data[k * SPAN : k * SPAN + SPAN]))
            columns = list(zip(*out)) if out else [[], [], [], []]
            kinds = (pa.int64(), pa.string(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["id", "lang", "at", "data"])

    spans = picked.select("doc_id", "lang", "text").mapInArrow(cut, "id bigint, lang string, at int, data binary")
    rows_ = sorted((r["lang"], r["id"], r["at"], bytes(r["data"])) for r in spans.collect())
    languages = sorted({r[0] for r in rows_})
    table = np.zeros((len(rows_), SPAN), np.uint8)
    for i, r in enumerate(rows_):
        table[i, : len(r[3])] = np.frombuffer(r[3], np.uint8)
    valid = np.arange(SPAN)[None] < np.array([len(r[3]) for r in rows_], np.int64).reshape(-1, 1)
    label = np.array([languages.index(r[0]) for r in rows_], np.int64)
    return fitted(table, valid, label, languages, hidden, steps)


def pooled(texts: pa.Array, network: Network) -> np.ndarray:
    """Mean of the positions' probabilities of each text, over all of its bytes."""
    data, at = W.string_bytes(texts)
    data = np.concatenate([data, np.zeros(SPAN, np.uint8)])
    first, length, text = _span_table(np.diff(at), at[:-1])
    total = np.zeros((len(texts), len(network.languages)), np.float64)
    for a in range(0, len(first), _AT_ONCE):
        part = slice(a, a + _AT_ONCE)
        bytes_ = data[first[part][None] + np.arange(SPAN)[:, None]]
        valid = np.arange(SPAN)[:, None] < length[part][None]
        bytes_[~valid] = 0
        p = probabilities(bytes_, network.weights)[0]
        p *= valid[..., None]
        np.add.at(total, text[part], p.sum(axis=0))
    return total / np.maximum(np.diff(at), 1)[:, None]


def with_language(docs: DataFrame, network: Network | None = None) -> DataFrame:
    """``docs`` without ``text`` but with ``held_out``, ``lang_pred`` and ``score``.

    The network labels every position of a text, span by span, from the bytes before and after it; the mean over all positions of the
    whole text gives the document's probabilities. Without a given network one is learned from the rows that are not held out.

    Null texts and those without a letter are ``und`` with score 0. If nothing can be learned (no labelled rows), all are. Ties go to the
    first language in code point order. Repeated rows have equal results; other columns pass through, and those of the three names are replaced.
    An empty table gives an empty table.
    """
    network = network or learned(docs)
    docs = docs.select(*[c for c in docs.columns if c.lower() not in ("held_out", "lang_pred", "score")])
    docs = docs.withColumn("held_out", held_out(F.col("doc_id")))
    schema = T.StructType([f for f in docs.schema.fields if f.name != "text"] + [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    model = docs.sparkSession.sparkContext.broadcast(vars(network))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_network = Network(**model.value)
        names = np.array(own_network.languages or [UNKNOWN], object)
        for batch in batches:
            texts = pc.fill_null(batch.column(batch.schema.get_field_index("text")), "")
            for a, b in W.text_slices(texts):
                own = texts.slice(a, b - a)
                known = _has_letter(own) & bool(own_network.languages)
                p = pooled(own, own_network) if own_network.languages else np.ones((b - a, 1))
                best = p.argmax(axis=1)
                pred = np.where(known, names[best], UNKNOWN)
                score = np.where(known, np.clip(p[np.arange(b - a), best], 0, 1), 0.0)
                part = batch.slice(a, b - a)
                columns = [part.column(batch.schema.get_field_index(f.name)) for f in schema.fields[:-2]]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(pred, pa.string()), pa.array(score)], names=schema.names)

    return docs.mapInArrow(run, schema)
