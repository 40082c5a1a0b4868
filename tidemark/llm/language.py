"""Language identification in two steps: the family first, then the languages inside it.

A text's features are the counts of its hashed letter n-grams (one to four bytes of the lower-cased
text, everything that is ASCII and no letter being a space). One linear support vector machine a family
picks the family; inside it, one machine for each pair of languages separates the closely related ones,
and the language that wins most of its pairs is predicted. Weights are whole numbers, so a text's sums
are exact and its result does not depend on the rows beside it.

Families are a fixed table of language codes; a language that is not in it is a family of its own.

Training is on a bounded sample: at most ``TRAIN_ROWS`` labelled rows, dealt evenly among the ``LANGUAGES``
most frequent languages and drawn by hash, whole texts each. What reaches the driver are the counts of
the sample. Every text is predicted whole, in windows.

Defined results: a null text, and one without a letter, is ``und`` with score 0; so is every text if there
is no row to learn from. With one learned language every other text has it. Rows that repeat count once in
training. A null id counts as the empty text. Other columns pass through; those named like a result are
replaced. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import words as W

UNKNOWN = "und"
TRAIN_ROWS, LANGUAGES = 2000, 64
GRAMS, BITS = (1, 2, 3, 4), 13
#: Texts whose counts stand in one matrix, and bytes that are hashed at once.
ROWS, BYTES = 64, 1 << 18
#: Languages (ISO 639-1) by family.
FAMILIES = {
    "germanic": "de en nl sv da no nb nn is af fy lb yi",
    "romance": "fr es it pt ro ca gl oc",
    "slavic": "ru uk be pl cs sk bg sr hr sl mk bs",
    "baltic": "lt lv",
    "celtic": "ga gd cy br",
    "uralic": "fi et hu",
    "turkic": "tr az kk ky uz tk tt",
    "semitic": "ar he mt am",
    "iranian": "fa ku ps tg",
    "indic": "hi bn mr ne pa gu ur si",
    "dravidian": "ta te kn ml",
    "austronesian": "id ms tl jv mg",
}
_FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes.split()}
_LETTERS = np.full(256, 32, np.uint8)
for _a, _z in ((0x41, 0x5B), (0x61, 0x7B), (0x80, 0x100)):
    _LETTERS[_a:_z] = np.arange(_a, _z)
_SPREAD = np.uint32(0x9E3779B1)


def family_of(language: str) -> str:
    """The family of a code such as ``de`` or ``pt-BR``; other languages are a family of their own."""
    return _FAMILY.get(language.lower().replace("_", "-").split("-")[0], language)


def hashed(data: np.ndarray, n: int, count: int) -> np.ndarray:
    """Bucket of the ``n`` bytes from each of the first ``count`` places."""
    key = np.full(count, n, np.uint32)
    for k in range(n):
        key = (key ^ data[k : k + count].astype(np.uint32)) * _SPREAD
        key ^= key >> np.uint32(15)
    return (key * _SPREAD) >> np.uint32(32 - BITS)


def counts(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """Rows ``first`` to ``last`` with the counts of their n-grams; no n-gram crosses a text's ends.

    Runs of spaces count as one space. A text longer than a window is read window by window.
    """
    wide, reach = 1 << BITS, max(GRAMS) - 1
    for first in range(0, len(offsets) - 1, ROWS):
        last = min(first + ROWS, len(offsets) - 1)
        out = np.zeros((last - first) * wide, np.int64)
        edges = offsets[first : last + 1]
        carried = np.zeros(0, np.uint8), np.zeros(0, np.int64)
        for a in range(int(edges[0]), int(edges[-1]), BYTES):
            b = min(a + BYTES, int(edges[-1]))
            byte = _LETTERS[data[a:b]]
            row = np.searchsorted(edges, np.arange(a, b), "right") - 1
            byte, row = np.concatenate([carried[0], byte]), np.concatenate([carried[1], row])
            again = (byte[1:] == 32) & (byte[:-1] == 32) & (row[1:] == row[:-1])
            keep = np.concatenate([[True], ~again])
            byte, row = byte[keep], row[keep]
            # N-grams that begin in the last places are counted with the next window, which holds all of them.
            done = len(byte) if b == edges[-1] else max(0, len(byte) - reach)
            for n in GRAMS:
                k = min(done, len(byte) - n + 1)
                if k > 0:
                    whole = row[:k] == row[n - 1 : n - 1 + k]
                    out += np.bincount(row[:k][whole] * wide + hashed(byte, n, k)[whole], minlength=len(out))
            carried = byte[done:], row[done:]
        yield first, last, out.reshape(last - first, wide)


@dataclass(frozen=True)
class Machines:
    """Linear machines: a column of whole-numbered weights and an offset each."""

    weights: np.ndarray
    offsets: np.ndarray

    def margins(self, x: np.ndarray, total: np.ndarray) -> np.ndarray:
        return (x @ self.weights) / (FINE * total[:, None]) + self.offsets


#: Weights are whole multiples of one over this.
FINE = 1 << 16


def separate(x: np.ndarray, rows: np.ndarray, y: np.ndarray, c: float = 10.0, rounds: int = 40) -> tuple[np.ndarray, float]:
    """Weights and offset of a linear support vector machine with squared hinge loss, by dual coordinate descent.

    It sees the given rows of ``x``; ``y`` is 1 or -1 for each. Both sides weigh the same, however many
    rows they have. The offset is the weight of a constant feature.
    """
    n, up = len(y), (y > 0).sum()
    room = np.where(y > 0, n / (2 * max(1, up)), n / (2 * max(1, n - up))) * c
    w, offset, dual = np.zeros(x.shape[1]), 0.0, np.zeros(n)
    norm = np.array([float(x[r] @ x[r]) for r in rows]) + 1 + 1 / (2 * room)
    draw = np.random.Generator(np.random.PCG64(13))
    for _ in range(rounds):
        most = 0.0
        for i in draw.permutation(n):
            own = x[rows[i]].astype(np.float64)
            slope = y[i] * (own @ w + offset) - 1 + dual[i] / (2 * room[i])
            step = max(-dual[i], -slope / norm[i])
            if step:
                dual[i] += step
                own *= step * y[i]
                w += own
                offset += step * y[i]
                most = max(most, abs(step) * norm[i])
        if most < 1e-3:
            break
    return w, offset


@dataclass(frozen=True)
class Model:
    """Machines for the families, and for the pairs of each family's languages."""

    languages: tuple[str, ...]
    families: tuple[str, ...]
    first: Machines | None
    pairs: Mapping[str, tuple[tuple[str, ...], tuple[tuple[int, int], ...], Machines | None]]

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Language and score of each row of counts."""
        total = np.maximum(1, x.sum(1)).astype(np.float64)
        x = x.astype(np.float64)
        chosen, score = np.zeros(len(x), np.int64), np.ones(len(x))
        if self.first is not None:
            margins = self.first.margins(x, total)
            chosen = margins.argmax(1)
            ranked = np.sort(margins, 1)
            score = _chance(ranked[:, -1] - ranked[:, -2])
        out = np.empty(len(x), object)
        for f in np.unique(chosen):
            names, pairs, machines = self.pairs[self.families[f]]
            rows = np.flatnonzero(chosen == f)
            if machines is None:
                out[rows] = names[0]
                continue
            margins = machines.margins(x[rows], total[rows])
            votes, sums = np.zeros((len(rows), len(names))), np.zeros((len(rows), len(names)))
            for k, (i, j) in enumerate(pairs):
                votes[:, i] += margins[:, k] >= 0
                votes[:, j] += margins[:, k] < 0
                sums[:, i] += margins[:, k]
                sums[:, j] -= margins[:, k]
            # Equal votes go by the sum of margins, within one vote.
            best = (votes + np.tanh(sums) / 4).argmax(1)
            least = np.full(len(rows), np.inf)
            for k, (i, j) in enumerate(pairs):
                least = np.where(best == i, np.minimum(least, margins[:, k]), np.where(best == j, np.minimum(least, -margins[:, k]), least))
            out[rows] = np.array(names, object)[best]
            score[rows] *= _chance(2 * least)
        return out, score


def _chance(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def _machines(x: np.ndarray, tasks: list[np.ndarray], scale: np.ndarray) -> Machines | None:
    """One machine for each vector of 1, -1 and 0 (rows it doesn't see)."""
    if not tasks:
        return None
    weights, offsets = [], []
    for y in tasks:
        seen = np.flatnonzero(y)
        w, offset = separate(x, seen, y[seen].astype(np.float64))
        weights.append(np.round(w * scale * FINE))
        offsets.append(offset)
    return Machines(np.stack(weights, 1), np.array(offsets))


def train(x: np.ndarray, languages: list[str]) -> Model:
    """A model from counts and the languages of their texts; the matrix is scaled in place."""
    names = sorted(set(languages))
    label = np.array(languages, object)
    x /= np.maximum(1, x.sum(1, keepdims=True))
    scale = 1 / np.sqrt(x.mean(0, dtype=np.float64) + 1 / (len(GRAMS) << BITS))
    x *= scale.astype(x.dtype)
    families = sorted({family_of(n) for n in names})
    own = np.array([family_of(n) for n in languages], object)
    first = [np.where(own == f, 1, -1) for f in families] if len(families) > 1 else []
    pairs = {}
    for f in families:
        inside = tuple(n for n in names if family_of(n) == f)
        met = tuple((i, j) for i in range(len(inside)) for j in range(i + 1, len(inside)))
        tasks = [np.where(label == inside[i], 1, np.where(label == inside[j], -1, 0)) for i, j in met]
        pairs[f] = inside, met, _machines(x, tasks, scale)
    return Model(tuple(names), tuple(families), _machines(x, first, scale), pairs)


def _folded(text: str) -> Column:
    """Lower case, with a space at both ends."""
    return F.concat(F.lit(" "), F.lower(F.col(text)), F.lit(" "))


def _has_letter(text: str) -> Column:
    return F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))


def sample(df: DataFrame, text: str, language: str, key: str, rows: int = TRAIN_ROWS, languages: int = LANGUAGES) -> tuple[np.ndarray, list[str]]:
    """Counts and languages of the training rows.

    A share of each language that gives somewhat more than its rows is drawn first, so what is sorted
    and sent does not grow with the table.
    """
    known = df.where(F.col(language).isNotNull())
    held = known.groupBy(F.col(language).alias("l")).agg(F.count(F.lit(1)).alias("n"))
    often = [(r.l, r.n) for r in held.orderBy(F.col("n").desc(), "l").limit(languages).collect()]
    if not often:
        return np.zeros((0, 1 << BITS), np.float32), []
    each = max(1, rows // len(often))
    share = F.create_map(*[F.lit(v) for name, n in often for v in (name, min(1.0, 2 * (each + 20) / n))])
    draw = F.xxhash64(F.col(key).cast("string"), text, F.lit(13))
    drawn = known.where(_has_letter(text)).select(F.col(language).alias("l"), draw.alias("d"), F.col(text).alias("t"))
    drawn = drawn.where(F.pmod("d", F.lit(2**32)) < F.element_at(share, F.col("l")) * 2**32).dropDuplicates(["l", "d"])
    nth = F.row_number().over(Window.partitionBy("l").orderBy("d"))
    drawn = drawn.withColumn("nth", nth).where(F.col("nth") <= each).select("l", "d", _folded("t").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, values = [], []
            for _, _, data, offsets in W.slices(batch.column("t")):
                for first, last, x in counts(data, offsets):
                    for row in x:
                        at = np.flatnonzero(row)
                        places.append(at.astype(np.uint16).tobytes())
                        values.append(row[at].astype("<i8").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("l"), batch.column("d"), pa.array(places, pa.binary()), pa.array(values, pa.binary())], ["l", "d", "at", "n"])

    W.narrow(df.sparkSession)
    found = sorted(drawn.mapInArrow(run, "l string, d bigint, at binary, n binary").collect(), key=lambda r: (r.l, r.d))
    x = np.zeros((len(found), 1 << BITS), np.float32)
    for i, r in enumerate(found):
        x[i, np.frombuffer(r["at"], np.uint16)] = np.frombuffer(r["n"], "<i8")
    return x, [r.l for r in found]


def fit(df: DataFrame, text: str = "text", language: str = "lang", key: str = "doc_id", rows: int = TRAIN_ROWS) -> Model | None:
    """A model of the labelled rows of ``df``; None without any."""
    x, languages = sample(df, text, language, key, rows)
    return train(x, languages) if languages else None


def predict(df: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """Add ``lang_pred`` and ``score``."""
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(model)
    kept = df.drop("lang_pred", "score")
    own = {c: f"_c{i}" for i, c in enumerate(kept.columns)}
    slim = kept.toDF(*own.values()).withColumn("_t", F.when(_has_letter(own[text]), _folded(own[text])))
    schema = T.StructType([*kept.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            told = batch.column("_t").is_valid().to_numpy(zero_copy_only=False)
            names, scores = np.full(batch.num_rows, UNKNOWN, object), np.zeros(batch.num_rows)
            for at, end, data, offsets in W.slices(batch.column("_t")):
                for first, last, x in counts(data, offsets) if shared.value is not None else ():
                    names[at + first : at + last], scores[at + first : at + last] = shared.value.predict(x)
            names[~told], scores[~told] = UNKNOWN, 0.0
            found = [pa.array(names, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *found], schema.names)

    W.narrow(spark)
    return slim.mapInArrow(run, schema)


def held_out(doc: str = "doc_id", folds: int = 4, fold: int = 2) -> Column:
    """Whether a row is kept from training, by its id."""
    return F.crc32(F.coalesce(F.col(doc).cast("string"), F.lit(""))) % folds == fold


def accuracy(judged: DataFrame, language: str = "lang") -> dict[str, tuple[int, int]]:
    """Right and all held-out rows of each language."""
    own = judged.where(F.col("held_out") & F.col(language).isNotNull())
    right = F.sum((F.col("lang_pred") == F.col(language)).cast("long"))
    return {r.l: (r.r, r.n) for r in own.groupBy(F.col(language).alias("l")).agg(right.alias("r"), F.count(F.lit(1)).alias("n")).collect()}
