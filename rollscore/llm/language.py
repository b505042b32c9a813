"""Language identification: averaged hashed subword embeddings under a linear softmax.

A text is the mean of the embeddings of its words' hashed character n-grams;
a linear layer and softmax give language probabilities. Embeddings and layer are
trained together by stochastic gradient descent in numpy on snippets of a bounded
sample (``TRAIN_DOCS`` documents of each language, up to ``TRAIN_TEXT_BYTES``
each; scoring has no such bounds). A part of the sample is kept aside to fit the
softmax temperature and the probability below which a prediction is rejected.

The mean and the layer are both linear, so a word's share of the outcome is one
short vector, computed once and remembered while the words recur.

Defined cases
* null text, or text without a letter: ``und``, score 0, rejected;
* a null doc_id counts as held out; a null lang teaches nothing;
* without any labelled document every text is ``und``;
* repeated rows give repeated results; other columns are never read;
* ties go to the language that sorts first.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .toxicity import TRIM, held_out

BUCKETS = 1 << 16
WIDTH = 16
GRAMS = (2, 3, 4)
TRAIN_DOCS = 1200
TRAIN_BYTES = 8 << 20
RANKED_AT_ONCE = 1000
SNIPPET = 40
BATCH = 64
STEPS = 1500
ACCEPT = 0.99
CACHE_WORDS = 300_000
CACHE_GRAMS = 1 << 19
UNKNOWN = "und"


class _Grams(dict):
    """Buckets of n-grams, hashed once each while remembered."""

    def __missing__(self, gram: str) -> int:
        if len(self) >= CACHE_GRAMS:
            self.clear()
        self[gram] = bucket = _bucket(gram)
        return bucket


def _bucket(gram: str) -> int:
    return zlib.crc32(gram.encode("utf-8", "surrogatepass")) % BUCKETS


_grams = _Grams()


def subwords(token: str) -> list[int]:
    """Buckets of the n-grams of a word between boundary marks, and of the word; none for a token without letters."""
    word = token.lower().strip(TRIM)
    if not (word.isalpha() or any(map(str.isalpha, word))):
        return []
    word = f"<{word}>"
    bucket = _grams.__getitem__
    out = [bucket(word[i : i + n]) for n in GRAMS for i in range(len(word) - n + 1)]
    out.append(_bucket(f"={word}"))
    return out


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # (buckets, languages): embedding times layer
    offset: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0


class Words:
    """Summed table rows and n-gram counts of words."""

    def __init__(self, model: Model):
        self.model = model
        self.clear()

    def clear(self):
        self.index: dict[str, int] = {}
        self.rows = np.zeros((1024, self.model.table.shape[1] + 1), np.float32)

    def totals(self, tokens: list[str]) -> np.ndarray:
        if len(self.index) > CACHE_WORDS:
            self.clear()
        index = self.index
        try:
            ids = np.fromiter(map(index.__getitem__, tokens), np.int64, len(tokens))
        except KeyError:
            self._add([t for t in dict.fromkeys(tokens) if t not in index])
            ids = np.fromiter(map(index.__getitem__, tokens), np.int64, len(tokens))
        return self.rows.take(ids, axis=0).sum(axis=0, dtype=np.float64)

    def _add(self, tokens: list[str]) -> None:
        """The rows of new words, all in one pass over their buckets."""
        n, grams, sizes = len(self.index), [], []
        for token in tokens:
            before = len(grams)
            grams += subwords(token)
            sizes.append(len(grams) - before)
        while n + len(tokens) > len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        sizes = np.array(sizes)
        self.rows[n : n + len(tokens)] = 0
        filled = np.flatnonzero(sizes)
        if len(filled):
            at = np.concatenate([[0], np.cumsum(sizes[filled])[:-1]])
            self.rows[n + filled, :-1] = np.add.reduceat(self.model.table.take(grams, axis=0), at)
        self.rows[n : n + len(tokens), -1] = sizes
        self.index.update(zip(tokens, range(n, n + len(tokens))))


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=-1, keepdims=True))
    return x / x.sum(axis=-1, keepdims=True)


def logits(text: str, words: Words) -> np.ndarray | None:
    totals = words.totals(text.split())
    return totals[:-1] / totals[-1] + words.model.offset if totals[-1] else None


def train(rows: list[tuple[str, str, bool]], seed: int = 5) -> Model:
    """``rows``: (text, language, kept aside for calibration)."""
    languages = sorted({lang for _, lang, _ in rows})
    if not languages:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0))
    code = {lang: i for i, lang in enumerate(languages)}
    rng = np.random.default_rng(seed)
    vocabulary: dict[str, int] = {}
    grams: list[np.ndarray] = []

    def ids(text):
        out = []
        for token in text.split():
            if token not in vocabulary:
                vocabulary[token] = len(grams)
                grams.append(np.array(subwords(token), np.int64))
            out.append(vocabulary[token])
        return out

    by_lang: list[list[list[int]]] = [[] for _ in languages]
    for text, lang, aside in rows:
        if not aside and (w := ids(text)):
            by_lang[code[lang]].append(w)
    seen = [i for i, docs in enumerate(by_lang) if docs]
    embedding = rng.uniform(-1, 1, (BUCKETS, WIDTH)) / WIDTH
    layer, offset = np.zeros((WIDTH, len(languages))), np.zeros(len(languages))
    for step in range(STEPS if len(seen) > 1 else 0):
        rate = 2.0 * (1 - step / STEPS)
        parts, y = [], []
        for _ in range(BATCH):
            lang = seen[rng.integers(len(seen))]
            doc = by_lang[lang][rng.integers(len(by_lang[lang]))]
            at = rng.integers(max(1, len(doc) - SNIPPET + 1))
            take = [grams[w] for w in doc[at : at + int(rng.integers(3, SNIPPET + 1))]]
            flat = np.concatenate(take)
            if len(flat):
                parts.append(flat)
                y.append(lang)
        if not parts:
            continue
        sizes = np.array([len(p) for p in parts])
        flat, y = np.concatenate(parts), np.array(y)
        mean = np.add.reduceat(embedding[flat], np.concatenate([[0], np.cumsum(sizes)[:-1]])) / sizes[:, None]
        slope = _softmax(mean @ layer + offset)
        slope[np.arange(len(y)), y] -= 1
        back = np.repeat(slope @ layer.T / sizes[:, None], sizes, axis=0)
        layer -= rate * mean.T @ slope / len(y)
        offset -= rate * slope.mean(axis=0)
        np.add.at(embedding, flat, -rate * back)
    model = Model(languages, (embedding @ layer).astype(np.float32), offset)
    return _calibrated(model, [(t, code[lang]) for t, lang, aside in rows if aside])


def _calibrated(model: Model, rows: list[tuple[str, int]]) -> Model:
    words = Words(model)
    found = [(z, y) for t, y in rows if (z := logits(t, words)) is not None]
    if not found:
        return model
    z, y = np.stack([f[0] for f in found]), np.array([f[1] for f in found])
    at = np.arange(len(y))
    loss = lambda t: -np.log(_softmax(z / t)[at, y] + 1e-12).mean()
    model.temperature = float(min(np.geomspace(0.05, 20, 120), key=loss))
    p = _softmax(z / model.temperature)
    order = np.argsort(-p.max(axis=1), kind="stable")
    right = np.cumsum(p.argmax(axis=1)[order] == y[order]) / np.arange(1, len(y) + 1)
    good = np.flatnonzero(right >= ACCEPT)
    model.threshold = float(p.max(axis=1)[order][good[-1]]) if len(good) else 1.0
    return model


def _predicted(model: Model):
    def run(batches):
        words = Words(model)
        for batch in batches:
            langs, scores, rejected = [], [], []
            for value in batch.column("text"):
                text = value.as_py() or ""
                lettered = any(map(str.isalpha, text))
                z = logits(text, words) if lettered and model.languages else None
                if z is None and lettered and model.languages:
                    z = model.offset  # letters, but none inside a word's marks: the prior decides
                if z is None:
                    langs.append(UNKNOWN), scores.append(0.0), rejected.append(True)
                    continue
                p = _softmax(z / model.temperature)
                best = int(p.argmax())
                langs.append(model.languages[best]), scores.append(float(p[best])), rejected.append(bool(p[best] < model.threshold))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())],
                names=["doc_id", "lang_pred", "score", "rejected"],
            )

    return run


def _chosen(rows: DataFrame, per_language: int) -> DataFrame:
    """At most ``per_language`` rows of each language in the order of a hash, and of those the first ones that hold
    ``TRAIN_BYTES`` together (a text is never left out for its length alone). Ranked in 64 parts of a language first,
    each of which keeps its first ones before the shuffle, so that no task sorts a language."""
    order = [F.xxhash64("doc_id"), "doc_id", "h"]
    rows = rows.withColumn("part", F.pmod(F.xxhash64("doc_id", "h"), F.lit(64)))
    first = min(per_language, RANKED_AT_ONCE)  # up to this the group limit acts before the shuffle
    for at, share in ((["lang", "part"], first), (["lang"], per_language)):
        place = Window.partitionBy(*at).orderBy(*order)
        rows = rows.withColumn("r", F.row_number().over(place)).where(F.col("r") <= share)
    before = Window.partitionBy("lang").orderBy("r").rowsBetween(Window.unboundedPreceding, -1)
    held = F.coalesce(F.sum("size").over(before), F.lit(0))
    return rows.withColumn("held", held).where(F.col("held") < TRAIN_BYTES).select("doc_id", "lang", "h").distinct()


def fit(documents: DataFrame, per_language: int = TRAIN_DOCS) -> Model:
    """Learns from documents with a language outside the held-out fifth, at most ``per_language`` of each."""
    known = documents.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out("doc_id"))
    keys = ["doc_id", "lang", F.xxhash64("text").alias("h")]
    sample = known.select(*keys, "text").join(F.broadcast(_chosen(known.select(*keys, F.octet_length("text").alias("size")), per_language)),
                                              ["doc_id", "lang", "h"]).distinct().collect()
    sample.sort(key=lambda r: (r.doc_id, r.lang, r.text))
    return train([(r.text, r.lang, zlib.crc32(str(r.doc_id).encode()) % 5 == 1) for r in sample])


def identify(documents: DataFrame, model: Model) -> DataFrame:
    out = T.StructType([
        documents.schema["doc_id"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
        T.StructField("rejected", T.BooleanType()),
    ])
    return documents.select("doc_id", "text").mapInArrow(_predicted(model), out)


def report(documents: DataFrame) -> DataFrame:
    return identify(documents, fit(documents)).select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score", "rejected")
