"""Language identification by nearest centroids.

Texts are TF-IDF vectors of hashed letter trigrams, of unit length.  Each language has several centroids, found by
spherical k-means over a bounded sample of labelled rows; a text takes the language of the centroid at the highest
cosine, and is rejected where even that one is much further away than texts of that language and length are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .words import utf8

#: Buckets of the hashed trigrams.
DIMENSIONS = 1 << 12
#: Labelled rows of a language that the classifier is fitted on, chosen by a hash of doc_id; centroids of each.
SAMPLE, CENTROIDS = 500, 3
#: A text is rejected below this share of the cosine that all but one in a hundred training texts of its language and
#: length reach; lengths are told apart by powers of two, texts of fewer trigrams than FEW say too little to be rejected,
#: and ENOUGH texts of a length (of the language, else of all) make a limit of its own.
REJECT, FEW, ENOUGH, LENGTHS = 0.5, 16, 20, 40
#: Bytes worked on at once.
BLOCK = 1 << 20

_SYMBOL = np.zeros(256, np.int64)
_SYMBOL[97:123] = _SYMBOL[65:91] = np.arange(1, 27)
_SYMBOL[128:] = 27 + np.arange(128)


def features(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each row the buckets of its letter trigrams (a letter and what stands on either side) and their counts."""
    data, offsets = utf8(column)
    out = []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        total = None
        for at in range(a, b, BLOCK):
            part = np.zeros(min(at + BLOCK, b) - at + 2, np.int64)
            low, high = max(a, at - 1), min(b, at + BLOCK + 1)
            part[low - at + 1 : high - at + 1] = _SYMBOL[data[low:high]]
            code = (part[:-2] * 160 + part[1:-1]) * 160 + part[2:]
            bucket = (code[part[1:-1] > 0] * 0x9E3779B1 >> 7) % DIMENSIONS
            counts = np.bincount(bucket, minlength=DIMENSIONS)
            total = counts if total is None else total + counts
        where = np.flatnonzero(total) if total is not None else np.zeros(0, np.int64)
        out.append((where, total[where] if len(where) else where))
    return out


@dataclass
class Model:
    languages: list[str] = field(default_factory=list)
    #: Of each centroid: its language's place in languages, and its unit vector.
    owner: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    centroids: np.ndarray = field(default_factory=lambda: np.zeros((0, DIMENSIONS), np.float32))
    idf: np.ndarray = field(default_factory=lambda: np.ones(DIMENSIONS))
    #: The least cosine of an accepted text, by language and power of two of its trigrams.
    limits: np.ndarray = field(default_factory=lambda: np.zeros((0, LENGTHS)))

    def predict(self, column: pa.Array) -> pa.Array:
        names, scores, rejected = [], [], []
        for where, counts in features(column):
            if not len(where) or not self.languages:
                names.append("und")
                scores.append(0.0)
                rejected.append(True)
                continue
            weight = np.sqrt(counts) * self.idf[where]
            cosine = self.centroids[:, where] @ (weight / np.linalg.norm(weight))
            best = int(np.argmax(cosine))
            names.append(self.languages[self.owner[best]])
            scores.append(float(min(1.0, max(0.0, cosine[best]))))
            rejected.append(scores[-1] < self.limits[self.owner[best], _length(counts)])
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())], ["lang", "score", "rejected"])


def _length(counts: np.ndarray) -> int:
    return min(int(counts.sum()).bit_length() - 1, LENGTHS - 1)


def _limits(language: np.ndarray, length: np.ndarray, reached: np.ndarray, languages: int) -> np.ndarray:
    """The least cosines, from those that training texts reach; a length without ENOUGH texts takes the limit of the next shorter one."""
    out = np.zeros((languages, LENGTHS))
    for k in range(languages):
        limit = 0.0
        for size in range(FEW.bit_length() - 1, LENGTHS):
            alike = length == size
            own = reached[alike & (language == k)]
            own = own if len(own) >= ENOUGH else reached[alike]
            if len(own) >= ENOUGH:
                limit = REJECT * float(np.quantile(own, 0.01))
            out[k, size] = limit
    return out


def held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % 5 == 0


def fit(docs: DataFrame, sample: int = SAMPLE, centroids: int = CENTROIDS) -> Model:
    """Learn from the rows that are not held out and have a text and a lang; a null doc_id is not learned from."""
    usable = docs.select("doc_id", "text", "lang").filter("doc_id is not null and lang is not null and text is not null").filter(~held_out())
    sizes = {r[0]: r[1] for r in usable.groupBy("lang").count().collect()}  # a row for each language
    if not sizes:
        return Model()
    order = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    cut = F.coalesce(*(F.when(F.col("lang") == name, F.lit(int((1 << 30) * min(1.0, sample / n)))) for name, n in sorted(sizes.items())))

    @F.arrow_udf("struct<where:array<int>,counts:array<int>>")
    def counted(column: pa.Array) -> pa.Array:
        found = features(column)
        kind = pa.list_(pa.int32())
        return pa.StructArray.from_arrays([pa.array([x[i].tolist() for x in found], kind) for i in (0, 1)], ["where", "counts"])

    found = usable.filter(order < cut).select("lang", order.alias("place"), counted("text").alias("x")).select("lang", "place", "x.where", "x.counts").toArrow().combine_chunks()
    lists = [found[c].combine_chunks() for c in ("where", "counts")]
    rows = sorted((lang, place, i) for i, (lang, place) in enumerate(zip(found["lang"].to_pylist(), found["place"].to_pylist(), strict=True)) if len(lists[0][i]))
    if not rows:
        return Model()
    matrix = np.zeros((len(rows), DIMENSIONS), np.float32)
    for i, (_, _, at) in enumerate(rows):
        matrix[i, lists[0][at].values.to_numpy()] = np.sqrt(lists[1][at].values.to_numpy())
    lengths = np.array([_length(lists[1][at].values.to_numpy()) for *_, at in rows])
    idf = 1 + np.log((1 + len(rows)) / (1 + np.count_nonzero(matrix, axis=0)))
    matrix *= idf.astype(np.float32)
    for row in matrix:
        row /= np.linalg.norm(row)
    names = sorted({r[0] for r in rows})
    owner, centres, reached = [], [], np.zeros(len(rows))
    language = np.array([names.index(r[0]) for r in rows])
    for k in range(len(names)):
        own = matrix[language == k]
        found = _clustered(own, min(centroids, len(own)))
        owner += [k] * len(found)
        centres.append(found)
        reached[language == k] = (own @ found.T).max(axis=1)
    return Model(names, np.array(owner), np.concatenate(centres), idf, _limits(language, lengths, reached, len(names)))


def _clustered(rows: np.ndarray, k: int, rounds: int = 15) -> np.ndarray:
    """Spherical k-means from far-apart seeds."""
    seeds = [int(np.argmax(rows @ rows.mean(axis=0)))]
    while len(seeds) < k:
        seeds.append(int(np.argmin((rows @ rows[seeds].T).max(axis=1))))
    centres = rows[seeds]
    for _ in range(rounds):
        nearest = np.argmax(rows @ centres.T, axis=1)
        sums = np.stack([rows[nearest == j].sum(axis=0) if (nearest == j).any() else centres[j] for j in range(k)])
        centres = (sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)).astype(np.float32)
    return centres


def lettered(text: Column) -> Column:
    """The text if it has a letter; signs and emoji beyond ASCII are none."""
    return F.when(text.rlike(r"\p{L}"), text)


def predictor(model: Model):
    """A function from a text column to struct(lang, score, rejected)."""

    @F.arrow_udf("struct<lang:string,score:double,rejected:boolean>")
    def predict(column: pa.Array) -> pa.Array:
        return model.predict(column)

    return predict


def identify(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score, rejected.

    A null text and one without a letter (of any script) is `und` with score 0 and rejected, as is every text if
    nothing could be learned.  Repeated rows and ties get the same answer, ties between centroids going to the language
    that sorts first.  A null doc_id is not held out.  Other columns are ignored; an empty table gives an empty result.
    """
    predict = predictor(model or fit(docs))
    rows = docs.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), predict(lettered(docs["text"])).alias("p"))
    return rows.select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"), F.col("p.rejected").alias("rejected"))


def accepted(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """The documents whose language is not rejected, with all their columns.

    A null text and one without a letter is rejected; repeated rows are kept or dropped alike; a null doc_id changes
    nothing; if nothing could be learned nothing is kept; an empty table gives an empty result.
    """
    return docs.filter(~predictor(model or fit(docs))(lettered(docs["text"]))["rejected"])
