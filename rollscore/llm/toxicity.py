"""Toxic spans by a linear-chain conditional random field, aggregated to document scores.

Training, on a bounded sample of labelled documents (``TRAIN_DOCS`` of each
class in the order of a hash, and of those the first ones that hold
``TRAIN_BYTES`` together; scoring has no such bounds):

1. tokens get labels from document labels: word features (word, prefixes,
   suffixes) are chosen greedily while each explains further toxic documents and
   occurs (almost) never in clean ones; tokens with a chosen feature in a toxic
   document are offending;
2. a two-state chain over hashed features of the word and its neighbours is fitted
   to these labels by gradient steps on the exact likelihood (forward-backward);
3. a logistic curve over the largest marginal and the expected number of
   offending tokens, fitted to the document labels at their original rate, gives
   the document score.

Scoring runs forward-backward over every token of every text. A batch's tokens
are one sequence whose transfer matrices restart at document starts; it is cut
into columns that advance together, so long texts cost no more per token.

Defined cases
* null or blank text: no tokens, the score of "nothing found", no spans;
* a document without, or with contradicting, labels trains nothing;
* without a labelled document of both classes every score is the share of toxic labels (or 0);
* a null doc_id counts as held out; repeated rows give repeated results;
* other columns, clashing names included, are never read.
"""

from __future__ import annotations

import io
import re
import zlib
from array import array
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .storage import whole_row

BUCKETS = 1 << 18
TRAIN_DOCS = 2000
TRAIN_BYTES = 8 << 20
EPOCHS = 40
CACHE_WORDS = 300_000
TRIM = ".,;:!?\"'()[]{}<>|*_-…«»“”"


def held_out(doc_id: str | Column) -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(True))


def word_features(token: str) -> list[str]:
    """Features of a token itself; the first kinds also serve to label tokens."""
    word = token.lower().strip(TRIM) or token.lower()
    return [f"w{word}", *(f"p{word[:n]}" for n in (3, 4, 5, 6) if len(word) > n), *(f"s{word[-n:]}" for n in (3, 4) if len(word) > n)]


def _bucket(name: str) -> int:
    return zlib.crc32(name.encode("utf-8", "surrogatepass")) % BUCKETS


@dataclass
class Chain:
    """Weights of offending against clean, by hashed feature; transitions, start; document curve."""

    own: np.ndarray
    before: np.ndarray  # weights of the previous word
    after: np.ndarray  # weights of the next word
    bias: float
    moves: np.ndarray  # log potentials, from x to
    start: np.ndarray
    curve: np.ndarray  # intercept, largest marginal's logit, log of the expected count


class Lexicon:
    """Scores of words, computed once each while remembered."""

    def __init__(self, chain: Chain):
        self.chain, self.index = chain, {}
        self.clear()

    def clear(self):
        self.index.clear()
        self.table = np.empty((1024, 3))

    def ids(self, tokens: list[str]) -> np.ndarray:
        index = self.index
        try:
            return np.fromiter(map(index.__getitem__, tokens), np.int64, len(tokens))
        except KeyError:
            self._add([t for t in dict.fromkeys(tokens) if t not in index])
            return np.fromiter(map(index.__getitem__, tokens), np.int64, len(tokens))

    def _add(self, tokens: list[str]) -> None:
        """The scores of new words, all in one pass over their features."""
        n, c, buckets, at = len(self.index), self.chain, [], []
        for token in tokens:
            at.append(len(buckets))
            buckets += map(_bucket, word_features(token))
        while n + len(tokens) > len(self.table):
            self.table = np.concatenate([self.table, np.empty_like(self.table)])
        buckets = np.array(buckets)
        new = self.table[n : n + len(tokens)]
        new[:, 0] = np.add.reduceat(c.own[buckets], at)
        new[:, 1], new[:, 2] = c.before[buckets[at]], c.after[buckets[at]]
        self.index.update(zip(tokens, range(n, n + len(tokens))))

    def emissions(self, tokens: list[str]) -> np.ndarray:
        ids = self.ids(tokens)
        own, before, after = self.table[ids].T
        out = own + self.chain.bias
        out[1:] += before[:-1]
        out[:-1] += after[1:]
        return out


def forward_backward(emissions: np.ndarray, starts: np.ndarray, moves: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Normalised forward and backward vectors (n, 2) of sequences laid end to end; ``starts`` marks first tokens."""
    n = len(emissions)
    width = max(1, int(np.sqrt(n)))
    steps = -(-n // width)
    # Transfer matrices by entry, as (steps, columns): column c holds tokens c * steps ... (c + 1) * steps - 1.
    weight = np.ones((2, width * steps))
    weight[1, :n] = np.exp(np.clip(emissions, -30, 30))
    # The filling after the last token is documents of their own, so that no message comes back from it.
    first = np.ones(width * steps, bool)
    first[:n] = starts
    entry = {}
    for i in (0, 1):
        for j in (0, 1):
            entry[i, j] = (np.where(first, np.exp(start[j]), np.exp(moves[i, j])) * weight[j]).reshape(width, steps).T.copy()
    one, zero = np.ones(width), np.zeros(width)

    def product():
        p = {(0, 0): one, (0, 1): zero, (1, 0): zero, (1, 1): one}
        for t in range(steps):
            p = {(i, j): p[i, 0] * entry[0, j][t] + p[i, 1] * entry[1, j][t] for i in (0, 1) for j in (0, 1)}
            scale = 1 / (p[0, 0] + p[0, 1] + p[1, 0] + p[1, 1])
            p = {k: v * scale for k, v in p.items()}
        return np.array([[p[0, 0], p[0, 1]], [p[1, 0], p[1, 1]]]).transpose(2, 0, 1)

    whole = product()
    enter, leave = np.empty((width, 2)), np.empty((width, 2))
    v = np.full(2, 0.5)
    for c in range(width):
        enter[c] = v
        v = v @ whole[c]
        v /= v.sum()
    v = np.full(2, 0.5)
    for c in range(width - 1, -1, -1):
        leave[c] = v
        v = whole[c] @ v
        v /= v.sum()
    alpha, beta = np.empty((steps, 2, width)), np.empty((steps, 2, width))
    a0, a1 = enter.T
    for t in range(steps):
        a0, a1 = a0 * entry[0, 0][t] + a1 * entry[1, 0][t], a0 * entry[0, 1][t] + a1 * entry[1, 1][t]
        s = 1 / (a0 + a1)
        a0, a1 = a0 * s, a1 * s
        alpha[t, 0], alpha[t, 1] = a0, a1
    b0, b1 = leave.T
    for t in range(steps - 1, -1, -1):
        beta[t, 0], beta[t, 1] = b0, b1
        b0, b1 = entry[0, 0][t] * b0 + entry[0, 1][t] * b1, entry[1, 0][t] * b0 + entry[1, 1][t] * b1
        s = 1 / (b0 + b1)
        b0, b1 = b0 * s, b1 * s
    flat = lambda x: x.transpose(2, 0, 1).reshape(-1, 2)[:n]
    return flat(alpha), flat(beta)


def marginals(emissions: np.ndarray, starts: np.ndarray, chain: Chain) -> np.ndarray:
    """Probability of the offending state at each token."""
    if not len(emissions):
        return np.empty(0)
    alpha, beta = forward_backward(emissions, starts, chain.moves, chain.start)
    joint = alpha * beta
    return joint[:, 1] / joint.sum(axis=1)


def _evidence(p: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """(documents, 3): 1, logit of the largest marginal, log of 1 + expected count."""
    out = np.zeros((len(lengths), 3))
    out[:, 0], out[:, 1] = 1, -12
    filled = np.flatnonzero(lengths)
    if len(filled):
        at = np.concatenate([[0], np.cumsum(lengths[filled])[:-1]])
        top = np.clip(np.maximum.reduceat(p, at), 6e-6, 1 - 6e-6)
        out[filled, 1] = np.log(top / (1 - top))
        out[filled, 2] = np.log1p(np.add.reduceat(p, at))
    return out


def _curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Ridge-regularised logistic regression by Newton steps."""
    w = np.zeros(x.shape[1])
    ridge = np.diag([1e-6, 1e-2, 1e-2]) * weight.sum() / 100
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (y - p)) - ridge @ w
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge + 1e-9 * np.eye(x.shape[1])
        step = np.linalg.solve(hessian, gradient)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return w


class Features:
    """Features of the sample's words as numbers, without their spellings: 64-bit hashes, numbered from 0."""

    def __init__(self, words: list[str]):
        self.words, hashes, buckets, sizes = words, array("Q"), array("i"), array("i")
        for word in words:
            names = word_features(word)
            hashes.extend(xxhash.xxh64_intdigest(n.encode("utf-8", "surrogatepass")) for n in names)
            buckets.extend(map(_bucket, names))
            sizes.append(len(names))
        self.at = np.concatenate([[0], np.cumsum(np.frombuffer(sizes, np.int32))]) if words else np.zeros(1, np.int64)
        self.bucket = np.array(buckets, np.int32)
        _, self.first, number = np.unique(np.array(hashes, np.uint64), return_index=True, return_inverse=True)
        self.number = number.astype(np.int32)

    def of(self, words: np.ndarray) -> np.ndarray:
        """Distinct features of distinct words."""
        return np.unique(np.concatenate([self.number[self.at[w] : self.at[w + 1]] for w in np.unique(words)]))

    def name(self, feature: int) -> str:
        place = self.first[feature]
        word = int(np.searchsorted(self.at, place, side="right")) - 1
        return word_features(self.words[word])[place - self.at[word]]

    def words_with(self, chosen: set[int]) -> np.ndarray:
        """For each word whether it has one of the features."""
        hit = np.isin(self.number, np.fromiter(chosen, np.int32, len(chosen)))
        return np.logical_or.reduceat(hit, self.at[:-1]) if len(self.words) else np.empty(0, bool)


def _offending_features(docs: list[np.ndarray], features: Features, toxic: np.ndarray) -> set[int]:
    """Greedy cover of the toxic documents by features (almost) absent from clean ones; ``docs`` hold word numbers."""
    count = len(features.first)
    everywhere, offending = np.zeros(count, np.int32), np.zeros(count, np.int32)
    filled = [d for d in range(len(docs)) if len(docs[d])]
    for d in filled:
        f = features.of(docs[d])
        everywhere[f] += 1
        if toxic[d]:
            offending[f] += 1
    need = max(3, int(toxic.sum()) // 400)
    kept = (everywhere >= need) & (offending >= 0.97 * everywhere)
    names = {f: features.name(f) for f in np.flatnonzero(kept).tolist()}
    pure: dict[int, set[int]] = {f: set() for f in names}
    for d in filled:
        if toxic[d]:
            for f in features.of(docs[d]).tolist():
                if kept[f]:
                    pure[f].add(d)
    left, chosen = set(np.flatnonzero(toxic).tolist()), set()
    while pure:
        # Most newly explained documents; of equals the longest feature, then the first by name.
        best = max(pure, key=lambda f: (len(pure[f]), len(names[f]), names[f]))
        gained = pure.pop(best)
        if len(gained) < need:
            break
        chosen.add(best)
        left -= gained
        pure = {k: v for k, old in pure.items() if len(v := old & left) >= need}
    return chosen


def _portions(docs: list[np.ndarray], size: int = 1 << 18):
    """Runs of documents of about ``size`` words, so that memory does not follow the sample."""
    first = held = 0
    for d, words in enumerate(docs):
        held += len(words)
        if held >= size or d + 1 == len(docs):
            yield first, d + 1
            first, held = d + 1, 0


def _first_words(lengths: np.ndarray) -> np.ndarray:
    starts = np.zeros(lengths.sum(), bool)
    starts[np.concatenate([[0], np.cumsum(lengths)[:-1]])[lengths > 0]] = True
    return starts


def train(texts: list[str], labels: list[int], rate: float) -> Chain:
    """``rate``: share of toxic among all labelled rows, for the document curve."""
    toxic = np.array(labels, bool)
    flat = Chain(np.zeros(BUCKETS, np.float32), np.zeros(BUCKETS, np.float32), np.zeros(BUCKETS, np.float32), 0.0, np.zeros((2, 2)), np.zeros(2), np.zeros(3))
    if not toxic.any() or toxic.all():
        flat.curve[0] = np.log(max(rate, 1e-6) / max(1 - rate, 1e-6))
        return flat
    words: dict[str, int] = {}
    docs = [np.array([words.setdefault(t, len(words)) for t in text.split()], np.int32) for text in texts]
    features = Features(list(words))
    lengths = np.array([len(d) for d in docs])
    bad = features.words_with(_offending_features(docs, features, toxic))
    size = len(words)
    feature, owner = features.bucket, np.repeat(np.arange(size, dtype=np.int32), np.diff(features.at))
    head = feature[features.at[:-1]]
    portions = []
    for a, b in _portions(docs):
        ids = np.concatenate(docs[a:b])
        if len(ids):
            portions.append((ids, _first_words(lengths[a:b]), bad[ids] & np.repeat(toxic[a:b], lengths[a:b])))
    n, ones = int(lengths.sum()), sum(float(y.sum()) for _, _, y in portions)

    own, before, after = np.zeros(BUCKETS), np.zeros(BUCKETS), np.zeros(BUCKETS)
    bias = np.array([np.log((ones + 1) / (n - ones + 1))])
    moves, start = np.zeros((2, 2)), np.zeros(2)
    squares = [np.full(x.shape, 1e-8) for x in (own, before, after, bias, moves, start)]
    total = max(1.0, ones)
    for _ in range(EPOCHS):
        word = np.bincount(owner, own[feature], size)
        per_word = np.zeros(size)
        to_before, to_after = -1e-3 * before, -1e-3 * after
        to_bias, to_moves, to_start = np.zeros(1), -1e-3 * moves, -1e-3 * start
        for ids, starts, y in portions:
            last, heads = np.append(starts[1:], True), head[ids]
            e = word[ids] + bias[0]
            e[1:] += np.where(starts[1:], 0, before[heads[:-1]])
            e[:-1] += np.where(last[:-1], 0, after[heads[1:]])
            alpha, beta = forward_backward(e, starts, moves, start)
            p = alpha[:, 1] * beta[:, 1] / (alpha * beta).sum(axis=1)
            r = (y - p) / total
            per_word += np.bincount(ids, r, size)
            to_before += np.bincount(heads[:-1], np.where(starts[1:], 0, r[1:]), BUCKETS)
            to_after += np.bincount(heads[1:], np.where(last[:-1], 0, r[:-1]), BUCKETS)
            to_bias += r.sum()
            inner = np.flatnonzero(~starts)
            weight = np.exp(np.clip(e[inner], -30, 30))
            pair = {(i, j): alpha[inner - 1, i] * np.exp(moves[i, j]) * beta[inner, j] * (weight if j else 1.0) for i in (0, 1) for j in (0, 1)}
            whole = sum(pair.values())
            for (i, j), v in pair.items():
                to_moves[i, j] += (((y[inner - 1] == i) & (y[inner] == j)).sum() - (v / whole).sum()) / total
            s = np.flatnonzero(starts)
            to_start += np.array([(p[s] - y[s]).sum(), (y[s] - p[s]).sum()]) / total
        to_own = np.bincount(feature, per_word[owner], BUCKETS) - 1e-4 * own
        gradients = (to_own, to_before, to_after, to_bias, to_moves, to_start)
        for x, g, q in zip((own, before, after, bias, moves, start), gradients, squares):
            q += g * g
            x += 0.3 * g / np.sqrt(q)
    chain = Chain(own.astype(np.float32), before.astype(np.float32), after.astype(np.float32), float(bias[0]), moves, start, np.zeros(3))
    lexicon, spelled, evidence = Lexicon(chain), list(words), []
    for a, b in _portions(docs):
        parts = [lexicon.emissions([spelled[w] for w in d]) for d in docs[a:b] if len(d)]
        e = np.concatenate(parts) if parts else np.empty(0)
        evidence.append(_evidence(marginals(e, _first_words(lengths[a:b]), chain), lengths[a:b]))
    weight = np.where(toxic, rate / toxic.mean(), (1 - rate) / (1 - toxic.mean()))
    chain.curve = _curve(np.concatenate(evidence), toxic.astype(float), weight)
    return chain


def score_texts(texts: list[str], lexicon: Lexicon) -> tuple[np.ndarray, list[list[tuple[int, int, float]]]]:
    """Document scores, and (start, stop, probability) of runs of offending tokens, in characters."""
    chain = lexicon.chain
    if len(lexicon.index) > CACHE_WORDS:
        lexicon.clear()
    docs = [t.split() for t in texts]
    lengths = np.array([len(d) for d in docs], np.int64)
    parts = [lexicon.emissions(d) for d in docs if d]
    e = np.concatenate(parts) if parts else np.empty(0)
    at = np.concatenate([[0], np.cumsum(lengths)])
    starts = np.zeros(len(e), bool)
    starts[at[:-1][lengths > 0]] = True
    p = marginals(e, starts, chain)
    scores = 1 / (1 + np.exp(-np.clip(_evidence(p, lengths) @ chain.curve, -30, 30)))
    spans: list[list[tuple[int, int, float]]] = [[] for _ in texts]
    hot = np.flatnonzero(p >= 0.5)
    for d in np.unique(np.searchsorted(at, hot, side="right") - 1).tolist():
        own, run = p[at[d] : at[d + 1]], None
        for k, m in enumerate(re.finditer(r"\S+", texts[d])):
            if k < len(own) and own[k] >= 0.5:
                run = (run[0], m.end(), max(run[2], float(own[k]))) if run else (m.start(), m.end(), float(own[k]))
            elif run:
                spans[d].append(run)
                run = None
        if run:
            spans[d].append(run)
    return scores, spans


GROUP_CHARS = 4 << 20


def _scored(chain: Chain, keep: list[str]):
    def groups(texts):
        group, size = [], 0
        for t in texts:
            group.append(t)
            size += len(t)
            if size >= GROUP_CHARS:
                yield group
                group, size = [], 0
        if group:
            yield group

    def run(batches):
        lexicon = Lexicon(chain)
        for batch in batches:
            scores, spans = [], []
            for group in groups(x.as_py() or "" for x in batch.column("text")):
                s, found = score_texts(group, lexicon)
                scores.append(s)
                spans += [[{"start": a, "stop": b, "p": q} for a, b, q in doc] for doc in found]
            kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("p", pa.float64())]))
            score = pa.array(np.concatenate(scores) if scores else [], pa.float64())
            rest = [batch.column(c) for c in keep]
            yield pa.RecordBatch.from_arrays([*rest, score, pa.array(spans, kind)], names=[*keep, "__score", "__spans"])

    return run


def _first(rows: DataFrame, label: int, count: int) -> DataFrame:
    """The first ``count`` rows of a class in the order of a hash, and of those the first that hold ``TRAIN_BYTES``."""
    order = [F.xxhash64("doc_id"), "doc_id", "h"]
    taken = rows.where(F.col("toxic") == label).orderBy(*order).limit(count)
    before = Window.partitionBy("toxic").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)  # of ``count`` rows
    held = F.coalesce(F.sum("size").over(before), F.lit(0))
    return taken.withColumn("held", held).where(F.col("held") < TRAIN_BYTES).select("doc_id", "toxic", "h")


def fit(documents: DataFrame, labels: DataFrame, per_class: int = TRAIN_DOCS) -> Chain:
    """Learns from labelled documents outside the held-out fifth; the sample is bounded by ``per_class`` texts."""
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("high"))
    known = known.where((F.col("toxic") == F.col("high")) & F.col("toxic").isin(0, 1) & ~held_out("doc_id"))
    docs = documents.where("text is not null").select("doc_id", "text", F.xxhash64("text").alias("h"))
    rows = known.join(docs.select("doc_id", "h", F.octet_length("text").alias("size")), "doc_id")
    rows = rows.select("doc_id", "toxic", "h", "size").distinct()
    counts = {r.toxic: r.n for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    chosen = _first(rows, 0, per_class).union(_first(rows, 1, per_class))  # at most 2 * per_class rows
    sample = docs.join(F.broadcast(chosen), ["doc_id", "h"]).select("doc_id", "toxic", "text").distinct()
    rate = counts.get(1, 0) / max(1, sum(counts.values()))
    return _trained_in_a_task(sample, rate)


def _trained_in_a_task(sample: DataFrame, rate: float) -> Chain:
    """Trains where executors have memory for it; only the weights come to the driver. The sample is bounded (``fit``)."""

    def run(batches):
        rows = [r for b in batches for r in zip(*(b.column(c).to_pylist() for c in ("doc_id", "text", "toxic")))]
        texts = {text: toxic for _, text, toxic in sorted(rows, key=lambda r: r[:2])}  # copies count once
        chain, sink = train(list(texts), list(texts.values()), rate), io.BytesIO()
        np.savez(sink, **{name: np.asarray(getattr(chain, name)) for name in Chain.__dataclass_fields__})
        yield pa.RecordBatch.from_pydict({"chain": pa.array([sink.getvalue()], pa.binary())})

    row = sample.repartition(1).mapInArrow(run, "chain binary").first()
    if row is None:  # an empty sample runs no task
        return train([], [], rate)
    stored = np.load(io.BytesIO(row.chain))
    return Chain(**{name: stored[name] if stored[name].ndim else float(stored[name]) for name in Chain.__dataclass_fields__})


def score(documents: DataFrame, chain: Chain, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of each row with ``__score`` and ``__spans`` (start, stop, p) of offending runs."""
    spans = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("stop", T.IntegerType()), T.StructField("p", T.DoubleType())]))
    out = T.StructType([*(documents.schema[c] for c in keep), T.StructField("__score", T.DoubleType()), T.StructField("__spans", spans)])
    columns = [F.col(f"`{c}`") for c in dict.fromkeys([*keep, "text"])]
    return documents.select(*columns).mapInArrow(_scored(chain, keep), out)


def report(documents: DataFrame, labels: DataFrame) -> DataFrame:
    scored = score(documents, fit(documents, labels), ["doc_id"]).withColumnRenamed("__score", "score")
    return scored.select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.size("__spans").alias("n_spans"), F.transform("__spans", lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"))).alias("spans"),
    )


def accepted(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents whose score stays below 0.5, all columns kept."""
    rows = documents.select("text", whole_row(documents, "text"))
    kept = score(rows, fit(documents, labels), ["text", "__all"]).where("__score < 0.5")
    return kept.select(*[F.col("text" if c == "text" else f"__all.`{c}`") for c in documents.columns])
