"""Language of texts: averaged hashed subword embeddings and a linear softmax, trained by stochastic gradient descent.

A word's subwords are its character 2- to 4-grams with word ends and the word itself, hashed into BUCKETS rows of
embeddings. As the average is linear, a text's logits are sums over its words, which workers cache.
"""

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborflow.llm.common import as_batch, gram_hashes, mix, texts_of, worker_cache

BUCKETS, DIMENSION = 1 << 16, 16
ROWS_PER_LANGUAGE = 400  # bound of the training sample; two examples are made of each row
SNIPPET_WORDS = 12
EPOCHS, BATCH, RATE = 6, 32, 40.0
REJECTED_SHARE = 0.0005  # of labelled calibration texts that may be rejected
SURELY_OTHER = 0.98  # no text is rejected whose chance of being of no learned language is smaller
PRIOR = 0.5  # count that each bucket has before any text
UNKNOWN = "und"
CACHE_WORDS = 1_000_000


def subwords(words: list) -> tuple:
    """Bucket of each subword of the words' letters, and the place of its word; a word without letters has none."""
    texts = [w if w.isalpha() else "".join(filter(str.isalpha, w)) for w in (word.decode().lower() for word in words)]
    sizes = np.array([len(t) + 2 if t else 0 for t in texts], np.int64)
    if not sizes.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    points = np.frombuffer("".join(f"<{t}>" for t in texts if t).encode("utf-32-le"), "<u4").astype(np.uint64)
    owner = np.repeat(np.arange(len(texts)), sizes)
    hashes, owners = [], []
    for size in (2, 3, 4):
        at = np.arange(max(0, len(points) - size + 1))
        at = at[owner[at] == owner[at + size - 1]]
        hashes.append(gram_hashes(points, at, size))
        owners.append(owner[at])
    whole = np.flatnonzero(sizes)
    hashes.append(mix(np.array([zlib.crc32(texts[i].encode()) for i in whole], np.uint64)))
    return (np.concatenate(hashes) % np.uint64(BUCKETS)).astype(np.int64), np.concatenate([*owners, whole])


@dataclass
class Model:
    """Logits that each bucket adds (BUCKETS x languages) and bias, temperature; and what rejection needs.

    familiar is the log-probability of each bucket in texts of each language. A text's familiarity is its average,
    of the best language; other weighs it with the number of subwords into a chance of being of no learned language.
    shares: of held-out labelled texts, shuffled ones and texts of a language left out, how many are rejected.
    """

    languages: list
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    familiar: np.ndarray
    other: np.ndarray
    threshold: float
    shares: tuple = ()


def _softmax(logits):
    powers = np.exp(logits - logits.max(axis=1, keepdims=True))
    return powers / powers.sum(axis=1, keepdims=True)


def _signs(familiarity: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """What the chance of being another language is taken from; short texts vary more."""
    length = np.log(np.maximum(sizes, 1.0))
    return np.stack([np.ones(len(length)), familiarity, length, familiarity * length], axis=1)


def _chance(signs: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(signs @ weights, -50, 50)))


def _logistic(signs: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Weights of a logistic regression, by Newton's method with a little decay; both classes weigh the same."""
    centre, scale = signs.mean(axis=0), signs.std(axis=0)
    centre[0], scale[0] = 0, 1
    scaled, weights = (signs - centre) / np.maximum(scale, 1e-9), np.zeros(signs.shape[1])
    share = np.where(other, 0.5 / max(1, other.sum()), 0.5 / max(1, (~other).sum())) * len(other)
    for _ in range(30):
        chance = _chance(scaled, weights)
        curve = (scaled * (share * chance * (1 - chance))[:, None]).T @ scaled + 0.01 * np.eye(len(weights))
        weights += np.linalg.solve(curve, scaled.T @ (share * (other - chance)) - 0.01 * weights)
    weights /= np.maximum(scale, 1e-9)
    weights[0] -= (weights * centre)[1:].sum()
    return weights


def _rejection(held: list, mixed: list, familiar: np.ndarray) -> tuple:
    """(weights, threshold, shares) from held-out texts, the same with their letters shuffled, and left-out languages.

    A text of a language is familiar by the best of all languages; left out, by the best of the others: what a text
    of an unknown language looks like. The threshold lets all but REJECTED_SHARE of the held-out texts pass.
    """
    known = _familiarity(held, familiar)
    size = np.array([e[3] for e in held], float)
    gold = np.array([e[0] for e in held])
    signs, other = [_signs(known.max(axis=1), size)], [np.zeros(len(held), bool)]
    if familiar.shape[1] > 1:
        left = known.copy()
        left[np.arange(len(held)), gold] = -np.inf
        signs.append(_signs(left.max(axis=1), size))
        other.append(np.ones(len(held), bool))
    if mixed:
        signs.append(_signs(_familiarity(mixed, familiar).max(axis=1), np.array([e[3] for e in mixed], float)))
        other.append(np.ones(len(mixed), bool))
    if len(signs) == 1:
        return np.zeros(4), 1.0, ()
    weights = _logistic(np.concatenate(signs), np.concatenate(other))
    chances = [_chance(s, weights) for s in signs]
    threshold = max(SURELY_OTHER, float(np.quantile(chances[0], 1 - REJECTED_SHARE)))
    return weights, threshold, tuple(float((c > threshold).mean()) for c in chances)


def _familiarity(examples: list, familiar: np.ndarray) -> np.ndarray:
    rows, starts, weights, _ = _stack(examples)
    return np.add.reduceat(familiar[rows] * weights[:, None], starts)


def train(examples: list, held: list, languages: list, mixed: list = (), seed: int = 7) -> Model:
    """examples, held and mixed are (language number, buckets, weights that add up to 1, subwords).

    held ones calibrate, mixed ones (shuffled texts, of no language) help to calibrate the rejection.
    """
    random = np.random.default_rng(seed)
    inner = random.normal(0, 0.05, (BUCKETS, DIMENSION)).astype(np.float32)
    outer, bias = np.zeros((DIMENSION, len(languages)), np.float32), np.zeros(len(languages), np.float32)
    outer += random.normal(0, 0.3, outer.shape)
    steps, step = max(1, EPOCHS * -(-len(examples) // BATCH)), 0
    for _ in range(EPOCHS):
        order = random.permutation(len(examples))
        for at in range(0, len(order), BATCH):
            part = [examples[i] for i in order[at : at + BATCH]]
            rows, starts, weights, gold = _stack(part)
            hidden = np.add.reduceat(inner[rows] * weights[:, None], starts)
            slope = _softmax(hidden @ outer + bias)
            slope[np.arange(len(part)), gold] -= 1
            rate = RATE * (1 - step / steps)
            back = (slope @ outer.T).astype(np.float32)
            sizes = np.diff(np.append(starts, len(rows)))
            outer -= 0.02 * rate / len(part) * (hidden.T @ slope)
            bias -= 0.002 * rate / len(part) * slope.sum(axis=0)
            np.subtract.at(inner, rows, rate * weights[:, None] * np.repeat(back, sizes, axis=0))
            step += 1
    table = (inner @ outer).astype(np.float32)
    counts = np.full((BUCKETS, len(languages)), PRIOR)
    for gold, buckets, weights, size in examples:
        counts[buckets, gold] += weights * size
    familiar = np.log(counts / counts.sum(axis=0)).astype(np.float32)
    temperature, other, threshold, shares = 1.0, np.zeros(4), 1.0, ()
    if held:
        rows, starts, weights, gold = _stack(held)
        logits = np.add.reduceat(table[rows] * weights[:, None], starts) + bias
        cost = lambda t: -np.log(_softmax(logits / t)[np.arange(len(gold)), gold] + 1e-12).mean()
        temperature = float(min(np.geomspace(0.2, 5, 41), key=cost))
        other, threshold, shares = _rejection(held, list(mixed), familiar)
    return Model(languages, table, bias, temperature, familiar, other, threshold, shares)


def _stack(part):
    sizes = [len(e[1]) for e in part]
    rows = np.concatenate([e[1] for e in part])
    weights = np.concatenate([e[2] for e in part]).astype(np.float32)
    return rows, np.cumsum(sizes) - sizes, weights, np.array([e[0] for e in part])


FEATURE_SCHEMA = pa.schema([("lang", pa.string()), ("held", pa.bool_()), ("mixed", pa.bool_()), ("size", pa.int64()), ("buckets", pa.list_(pa.int32())), ("weights", pa.list_(pa.float32()))])


def _shuffled(words: list) -> list:
    """The words with all their characters in a new order, drawn from the words themselves."""
    letters = list(b" ".join(words).decode())
    np.random.default_rng(zlib.crc32(b" ".join(words))).shuffle(letters)
    return "".join(letters).encode().split()


def _features(batches):
    """Each labelled text, and a few consecutive words of it, as weighted buckets: bounded however long it is.

    Held-out ones come once more with their letters shuffled.
    """
    for batch in batches:
        out = {f.name: [] for f in FEATURE_SCHEMA}
        for lang, held, text in zip(batch.column("lang").to_pylist(), batch.column("held").to_pylist(), texts_of(batch, "text")):
            words = text.split()
            at = zlib.crc32(text) % max(1, len(words) - SNIPPET_WORDS + 1)
            parts = [(False, words), (False, words[at : at + SNIPPET_WORDS])]
            if held:
                parts += [(True, _shuffled(part)) for _, part in parts]
            for mixed, part in parts:
                counts: dict = {}
                for word in part:
                    counts[word] = counts.get(word, 0) + 1
                rows, owner = subwords(list(counts))
                total = np.bincount(rows, np.array([*counts.values()], float)[owner], BUCKETS)
                buckets = np.flatnonzero(total)
                if len(buckets):
                    for name, value in zip(out, (lang, held, mixed, int(total.sum()), buckets.astype(np.int32), (total[buckets] / total.sum()).astype(np.float32))):
                        out[name].append(value)
        yield as_batch(out, FEATURE_SCHEMA)


def fold_of(id_col: str):
    """crc32 of the id as text, modulo 5; rows of fold 0 and rows without id are never learned from."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", rows_per_language: int = ROWS_PER_LANGUAGE) -> Model:
    """Model of a sample of about rows_per_language labelled rows per language, chosen by a hash of id and text.

    The model has a column for each distinct lang, so lang is meant to have few values (languages).
    """
    labelled = docs.where((fold_of(id_col) != 0) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    labelled = labelled.select(F.col(lang_col).cast("string").alias("lang"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    # One number per language, of which the model has a column each anyway; no text is shuffled.
    counts = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    if not counts:
        return _nothing()
    shares = F.create_map(*[F.lit(v) for lang, n in sorted(counts.items()) for v in (lang, rows_per_language / n)])
    # Drawn by id and text: a table whose rows share an id is no larger a sample.
    draw = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), "text", F.lit(11)), F.lit(1 << 30)) / float(1 << 30)
    drawn = labelled.where(draw < shares[F.col("lang")])
    held = (fold_of("doc_id") == 1).alias("held")
    rows = drawn.select("lang", held, "text").mapInArrow(_features, "lang string, held boolean, mixed boolean, size long, buckets array<int>, weights array<float>").toArrow()
    rows = rows.combine_chunks().to_batches() if rows.num_rows else []
    if not rows:
        return _nothing()
    lang, held, mixed, size = (rows[0].column(n).to_pylist() for n in ("lang", "held", "mixed", "size"))
    places = rows[0].column("buckets").offsets.to_numpy()
    buckets, weights = (rows[0].column(n).values.to_numpy() for n in ("buckets", "weights"))
    number = {name: i for i, name in enumerate(sorted(set(lang)))}
    examples = [(number[lang[i]], buckets[a:b], weights[a:b], size[i], held[i], mixed[i]) for i, (a, b) in enumerate(zip(places, places[1:]))]
    examples.sort(key=lambda e: (e[0], len(e[1]), e[1].tobytes(), e[2].tobytes()))  # the same order however rows come
    of = lambda held, mixed: [e[:4] for e in examples if e[4:] == (held, mixed)]
    return train(of(False, False) or of(True, False), of(True, False), sorted(number), of(True, True))


def _nothing() -> Model:
    """What an empty sample teaches."""
    return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0, np.float32), 1.0, np.zeros((BUCKETS, 0), np.float32), np.zeros(4), 1.0)


class _Words:
    """Summed logits and familiarities, and number of subwords, of each word met."""

    def __init__(self, model: Model):
        self.model = model
        self.clear()

    def clear(self):
        self.places: dict = {}
        self.sums = np.zeros((1024, 2 * len(self.model.languages)), np.float32)
        self.counts = np.zeros(1024)

    def learn(self, words):
        fresh = [w for w in words if w not in self.places]
        if len(self.places) + len(fresh) > CACHE_WORDS:
            self.clear()
            fresh = list(words)
        first = len(self.places)
        while first + len(fresh) > len(self.counts):
            self.sums = np.concatenate((self.sums, np.zeros_like(self.sums)))
            self.counts = np.concatenate((self.counts, np.zeros_like(self.counts)))
        for at in range(0, len(fresh), 50_000):
            part = fresh[at : at + 50_000]
            rows, owner = subwords(part)
            place = slice(first + at, first + at + len(part))
            for column, values in enumerate([*self.model.table.T, *self.model.familiar.T]):
                self.sums[place, column] = np.bincount(owner, values[rows], len(part))
            self.counts[place] = np.bincount(owner, minlength=len(part))
        self.places.update(zip(fresh, range(first, first + len(fresh))))

    def signs(self, words):
        """(logits, familiarity, number of subwords) of a text, or None without letters."""
        at = np.fromiter(map(self.places.__getitem__, words), np.int64, len(words))
        count = self.counts[at].sum() if len(at) else 0
        if not count:
            return None
        mean, n = self.sums[at].sum(axis=0, dtype=np.float64) / count, len(self.model.languages)
        return mean[:n] + self.model.bias, mean[n:].max(), count


def _judge(text, words: _Words):
    found = words.signs(text) if words.model.languages else None
    if found is None:
        return UNKNOWN, 0.0, True
    logits, familiarity, size = found
    chances = _softmax(logits[None] / words.model.temperature)[0]
    best = int(chances.argmax())
    other = _chance(_signs(np.array([familiarity]), np.array([size])), words.model.other)[0]
    return words.model.languages[best], float(chances[best]), bool(other > words.model.threshold)


def predict(docs: DataFrame, model: Model, text_col: str = "text", prefix: str = "") -> DataFrame:
    """All columns of docs with lang_pred, score and rejected (names get the prefix); one pass, no shuffle.

    lang_pred is a learned language, or `und` with score 0 and rejected for a text that is null or without letters
    (or if nothing could be learned). rejected also holds for a text that is too unlike all learned
    languages, see Model. The whole text counts.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS rows, whatever the corpus is

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def judged(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        words = worker_cache("language", id(shared.value), lambda: _Words(shared.value))
        for texts in series:
            found = []
            for at in range(0, len(texts), 500):
                parts = [(t or "").encode().split() for t in texts.iloc[at : at + 500]]
                words.learn({w for p in parts for w in p})
                found.extend(_judge(p, words) for p in parts)
            yield pd.DataFrame(found, columns=["lang_pred", "score", "rejected"])

    names = {n: f"{prefix}{n}" for n in ("lang_pred", "score", "rejected")}
    out = docs.withColumn("__judged", judged(F.col(text_col)))
    return out.select(*docs.columns, *[F.col(f"__judged.{n}").alias(v) for n, v in names.items()])
