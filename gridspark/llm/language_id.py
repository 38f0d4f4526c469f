"""Language identification: averaged hashed subword embeddings and a linear softmax.

A text is the average of the embeddings of its subwords, the byte n-grams of its words with
their borders, hashed to a table. Embeddings and softmax are trained in numpy by stochastic
gradient descent on a bounded sample of labelled rows. Both are linear, so for prediction each
subword carries its scores and a text's are their average; subwords not seen in training say
nothing, so that a text of other words comes near the languages' shares. Labelled rows kept from
training, whole, in pieces down to a word and with letters exchanged, give the temperature, with
which scores are probabilities, and by language two lower bounds, for the score and for the
share of subwords seen in training: low quantiles of these rows. Texts below a bound are
rejected. Languages with few kept rows take half the quantile of all.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridspark.llm.common import SAMPLED_CHARS
from gridspark.llm.text_hash import bytes_of, runs

SIZES, BUCKETS_LOG2, DIM = (2, 3, 4), 16, 12
#: Labelled rows sampled for a language, about; epochs; share kept for calibration.
PER_LANGUAGE, EPOCHS, KEPT_SHARE = 500, 4, 0.25
#: Languages learned at most, those with most labelled rows.
LANGUAGES = 500
#: Bounds for a language: these quantiles of the known shares and of the scores of its kept rows and pieces, if they
#: are so many; the known share may be lower by MARGIN, as other texts have other words.
LOW, LOW_SCORE, ENOUGH, MARGIN = 0.01, 0.002, 20, 0.08
#: Share of letters exchanged in noised pieces, at most.
NOISE = 0.6
#: The known share of a text is raised by SPREAD over the root of its number of subwords before it is compared, as that of short texts varies.
SPREAD = 1.0
_BORDER = np.uint8(32)
_LETTERS = np.full(256, 32, np.uint8)
_LETTERS[65:91] = np.arange(97, 123)
_LETTERS[97:123] = np.arange(97, 123)
_LETTERS[128:] = np.arange(128, 256)


def subwords(data: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each size, buckets of all n-grams of a run of texts, and where each text's begin."""
    begin = int(offsets[0])
    raw = data[begin : int(offsets[-1])]
    offsets = offsets - begin
    low = _LETTERS[raw]
    if len(low) > 1:  # À to Þ as à to þ
        low[1:] += np.uint8(32) * ((low[:-1] == 0xC3) & (low[1:] >= 0x80) & (low[1:] <= 0x9E) & (low[1:] != 0x97))
    # A border before and after each text.
    n_docs = len(offsets) - 1
    padded = np.full(len(low) + n_docs + 1, _BORDER)
    lengths = np.diff(offsets)
    padded[np.arange(len(low)) + 1 + np.repeat(np.arange(n_docs), lengths)] = low
    starts = offsets + np.arange(n_docs + 1)
    border = padded == _BORDER
    out = []
    for size in SIZES:
        n = len(padded) - size + 1
        if n <= 0:
            out.append((np.zeros(0, np.uint16), np.zeros(n_docs + 1, np.int64)))
            continue
        code, inner = np.zeros(n, np.uint32), np.zeros(n, bool)
        for j in range(size):
            code |= padded[j : j + n].astype(np.uint32) << np.uint32(8 * j)
            if 0 < j < size - 1:
                inner |= border[j : j + n]
        at = np.flatnonzero(~inner & ~(border[:n] & border[size - 1 :]))
        code = (code[at] + np.uint32(size)) * np.uint32(0x9E3779B1)
        out.append((((code ^ (code >> np.uint32(15))) * np.uint32(0x85EBCA77) >> np.uint32(32 - BUCKETS_LOG2)).astype(np.uint16), np.searchsorted(at, starts)))
    return out


@dataclass
class Model:
    languages: list[str]
    scores: np.ndarray  # bucket, language: float32; the last column: 1 where the bucket was seen in training
    bias: np.ndarray
    least_score: np.ndarray  # by language
    least_known: np.ndarray
    temperature: float = 1.0

    def averages(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Average scores and share of known subwords of each text of a run, and its number of subwords."""
        sums = np.zeros((len(offsets) - 1, self.scores.shape[1]), np.float64)
        total = np.zeros(len(offsets) - 1)
        for buckets, first in subwords(data, offsets):
            counts = np.diff(first)
            full = np.flatnonzero(counts)
            if len(full):
                sums[full] += np.add.reduceat(self.scores[buckets], first[full], axis=0)
            total += counts
        return sums / np.maximum(total, 1)[:, None], total

    def probabilities(self, averages: np.ndarray) -> np.ndarray:
        z = (averages[:, :-1] + self.bias) / self.temperature
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


def _tolerance(total: np.ndarray) -> np.ndarray:
    """By how much the known share of a text of so many subwords can be off by chance."""
    return SPREAD / np.sqrt(np.maximum(total, 1))


def _pack_texts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in texts])]).astype(np.int64)


def fit(texts: list[str], labels: list[str], seed: int = 5) -> Model:
    """Trains on some of the texts, and on a short piece of each, and calibrates on the others."""
    rng = np.random.default_rng(seed)
    languages = sorted(set(labels))
    y = np.array([languages.index(x) for x in labels], np.int64)
    if not languages:
        return Model([], np.zeros((1 << BUCKETS_LOG2, 1), np.float32), np.zeros(0), least_score=np.zeros(0), least_known=np.zeros(0))
    kept = rng.random(len(texts)) < KEPT_SHARE
    if kept.all() or not kept.any():
        kept[:] = False
    whole = [x.encode() for x in texts]
    train = [(whole[i], y[i]) for i in np.flatnonzero(~kept)]
    for text, label in list(train):
        words = text.split()
        if words:
            a = int(rng.integers(0, len(words)))
            train.append((b" ".join(words[a : a + int(rng.integers(2, 30))]), label))
    size = 1 << BUCKETS_LOG2
    bags, seen = [], np.zeros(size, bool)
    for text, label in train:
        found = np.concatenate([b for b, _ in subwords(*_pack_texts([text]))]).astype(np.int64)
        if len(found):
            at, n = np.unique(found, return_counts=True)
            bags.append((at, (n / n.sum()).astype(np.float32), label))
            seen[at] = True
    table = (rng.standard_normal((size, DIM)) / DIM).astype(np.float32)
    weights, bias = np.zeros((DIM, len(languages)), np.float32), np.zeros(len(languages), np.float32)
    share = np.bincount(y, minlength=len(languages)) / len(y)
    steps, step = EPOCHS * max(1, len(bags)), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(bags)):
            at, n, label = bags[i]
            rate = 2.0 * (1 - step / steps)
            step += 1
            hidden = n @ table[at]
            z = hidden @ weights + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[label] -= 1
            p *= min(3.0, 1 / (len(languages) * share[label]))  # rare languages count as much
            back = weights @ p
            weights -= rate * np.outer(hidden, p)
            bias -= 0.1 * rate * p
            # Subwords of an average share its step; scaled up so that each moves about as in a text of 20.
            table[at] -= (rate * np.minimum(1.0, n * 20))[:, None] * back
    scores = np.concatenate([(table @ weights) * seen[:, None], seen[:, None]], axis=1).astype(np.float32)
    model = Model(languages, scores, bias.astype(np.float64), least_score=np.zeros(len(languages)), least_known=np.zeros(len(languages)))
    check = np.flatnonzero(kept) if kept.any() else np.arange(len(texts))
    tried = harder([whole[i] for i in check], rng)
    averages, _ = model.averages(*_pack_texts([*(whole[i] for i in check), *tried]))
    all_labels = np.concatenate([y[check], y[check]])
    temperatures = np.geomspace(0.01, 10_000, 140)
    losses = []
    for t in temperatures:
        model.temperature = float(t)
        losses.append(-np.log(np.maximum(model.probabilities(averages)[np.arange(len(all_labels)), all_labels], 1e-9)).mean())
    model.temperature = float(temperatures[int(np.argmin(losses))])
    # Bounds: what nearly all kept rows of a language reach, whole and in short pieces; the score's counts the harder pieces too.
    spread = model.probabilities(averages).max(axis=1)
    pieces = []
    for i in check:
        words = whole[i].split()
        if words:
            a = int(rng.integers(0, len(words)))
            pieces.append((b" ".join(words[a : a + int(rng.integers(5, 30))]), y[i]))
    rows = [(text, label) for text, label in [*((whole[i], y[i]) for i in check), *pieces] if len(text) >= 20]
    if rows:
        (averages, total), label = model.averages(*_pack_texts([x for x, _ in rows])), np.array([x for _, x in rows])
        score, known = model.probabilities(averages).max(axis=1), averages[:, -1] + _tolerance(total)
        for k in range(len(languages)):
            own, scored = label == k, all_labels == k
            enough = kept.any() and own.sum() >= ENOUGH
            own, scored, part = (own, scored, 1.0) if enough else (np.ones(len(rows), bool), np.ones(len(all_labels), bool), 0.5)
            model.least_known[k] = part * max(0.0, float(np.quantile(known[own], LOW)) - MARGIN)
            model.least_score[k] = part * float(np.quantile(np.concatenate([score[own], spread[scored]]), LOW_SCORE))
    return model


def harder(texts: list[bytes], rng: np.random.Generator) -> list[bytes]:
    """A piece of one to eight words of each text, in every second one of which letters are exchanged for others."""
    out = []
    for k, text in enumerate(texts):
        words = text.split() or [b""]
        a = int(rng.integers(0, len(words)))
        piece = np.frombuffer(b" ".join(words[a : a + int(rng.integers(1, 9))]), np.uint8).copy()
        if k % 2:
            at = np.flatnonzero((_LETTERS[piece] != _BORDER) & (piece < 128) & (rng.random(len(piece)) < NOISE * rng.random()))
            piece[at] = rng.integers(97, 123, len(at))
        out.append(piece.tobytes())
    return out


def held_out(doc_id: Column) -> Column:
    """Rows no model may learn from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def sample(docs: DataFrame, per_language: int = PER_LANGUAGE, languages: int = LANGUAGES) -> tuple[list[str], list[str]]:
    """Texts and languages of about per_language labelled rows of each language that are not held out.

    The rows are those with the smallest hashes of id and text: a share of each language by its
    count over all documents; rows that repeat count once. At most twice as many rows in all are
    taken, and the languages with most rows, so many at most. Of a longer text the first SAMPLED_CHARS
    are taken.
    """
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    labelled = labelled.select("doc_id", "lang", "text")
    counts = labelled.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(languages).collect()
    if not counts:
        return [], []
    place = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30))
    each = [F.struct(F.lit(r["lang"]).alias("lang"), F.lit(int((1 << 30) * min(1.0, per_language / r["count"]))).alias("share")) for r in counts]
    shares = docs.sparkSession.range(1).select(F.inline(F.array(*each)))
    chosen = labelled.join(F.broadcast(shares), "lang").where(place < F.col("share")).dropDuplicates(["doc_id", "lang", "text"])
    chosen = chosen.orderBy(place, "doc_id", "lang", "text").limit(2 * per_language * len(counts))
    rows = chosen.select("doc_id", "lang", F.substring("text", 1, SAMPLED_CHARS).alias("text")).collect()
    rows.sort(key=lambda r: (r["doc_id"], r["lang"], r["text"]))
    return [r["text"] for r in rows], [r["lang"] for r in rows]


def predict(model: Model, texts: pa.Array) -> dict[str, pa.Array]:
    """lang_pred, score, known and rejected of an Arrow column of texts."""
    data, offsets = bytes_of(texts)
    out: dict[str, list] = {"lang_pred": [], "score": [], "known": [], "rejected": []}
    for a, b in runs(offsets):
        own = offsets[a : b + 1]
        (averages, total), letters = model.averages(data, own), _has_letter(data, own)
        pred, score, known = np.full(b - a, "und", object), np.zeros(b - a), averages[:, -1]
        rejected = ~letters
        if model.languages:
            p = model.probabilities(averages)
            best = p.argmax(axis=1)
            pred = np.where(letters, np.array(model.languages, object)[best], "und")
            score = np.where(letters, p[np.arange(b - a), best], 0.0)
            rejected |= (score < model.least_score[best]) | (known + _tolerance(total) < model.least_known[best])
        rejected |= pred == "und"
        for column, x in zip(out.values(), (pred, score, known, rejected)):
            column.append(x)
    kinds = {"lang_pred": pa.string(), "score": pa.float64(), "known": pa.float64(), "rejected": pa.bool_()}
    return {k: pa.array(np.concatenate(v) if v else [], kinds[k]) for k, v in out.items()}


def identify(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """One row a row of docs: doc_id, held_out, lang_pred, score, known, rejected.

    The language of the whole text, by a model that is trained on the same table unless one is
    given; lang, source and doc_id are no inputs. score is the calibrated probability of
    lang_pred. Null texts and texts without a letter are 'und' with score 0, as all are where no
    row has a label. rejected: 'und', or score or known (the share of subwords seen in training)
    below the model's bounds for it. Rows that repeat are predicted each; an empty table gives no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("lang").cast("string"))
    model = docs.sparkSession.sparkContext.broadcast(model or fit(*sample(docs)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id")} | predict(model.value, batch.column("text")))

    out = docs.select("doc_id", "text").mapInArrow(run, "doc_id long, lang_pred string, score double, known double, rejected boolean")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "known", "rejected")


def drop_unknown_languages(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """The rows of docs whose language is not rejected, with their columns."""
    model = docs.sparkSession.sparkContext.broadcast(model or fit(*sample(docs)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pc.invert(predict(model.value, batch.column("text"))["rejected"]))

    return docs.mapInArrow(run, docs.schema)


def _has_letter(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """By text: is there a letter. ASCII letters are counted, other texts looked through."""
    raw = data[int(offsets[0]) : int(offsets[-1])]
    letter = (raw < 128) & (_LETTERS[raw] != _BORDER)
    sums = np.concatenate([[0], np.cumsum(letter, dtype=np.int64)])
    at = offsets - offsets[0]
    found = sums[at[1:]] > sums[at[:-1]]
    for i in np.flatnonzero(~found).tolist():
        found[i] = any(map(str.isalpha, bytes(raw[at[i] : at[i + 1]]).decode()))
    return found
