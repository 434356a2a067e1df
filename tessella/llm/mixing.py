"""Mixing sources to target weights by cube-method balanced sampling.

Every document is taken a whole number of times: the integer part of target / size of its source, and once more with the
remaining inclusion probability.  The cube method's flight moves these fractional probabilities along the null space of
two balancing totals, documents and words, until each is 0 or 1; every move is a fair game, so each document keeps its
probability.  Large units are landed first, against all smaller ones, so that what is left to land is small.

Flights run in blocks of bounded size.  The fractional units that a block leaves (a few, the smallest) meet in the blocks
of the next level, so a source that holds most rows is worked on by as many tasks as its rows fill, and the last level of
a source is one small landing problem.
"""

from __future__ import annotations

from fractions import Fraction
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import keep, local, stored
from .words import count_words

#: Weights of the sources by code point, repeating; share of all words that the mix takes; most copies of a document.
WEIGHTS, SHARE, MOST = (5, 2, 1), 1.5, 2.0
#: Units of a block.
BLOCK = 4096
#: Units of a landing problem; so many times three are left by the flight that balances both totals.
LAND = 10
#: Probabilities this close to 0 or 1 have landed.
EPSILON = 1e-9


@F.arrow_udf(T.LongType())
def _words(column: pa.Array) -> pa.Array:
    return pa.array(count_words(column), pa.int64())


#: Not to be moved: a filter that is pushed below it counts the words once more, in a second Python worker for each task.
_words = _words.asNondeterministic()


def words(text: str | Column = "text") -> Column:
    """Number of `[^\\x20\\x09-\\x0D]+` in a text; null has none."""
    return _words(text)


def targets(sizes: dict[str | None, int], weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> dict[str | None, float]:
    """Words to take from each source: share of all words by weight, none above most times its size."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: Fraction(weights[i % len(weights)]) for i, s in enumerate(names)}
    cap = {s: Fraction(most) * sizes[s] for s in names}
    left, out, free = Fraction(share) * sum(sizes.values()), {}, names
    while free:
        total = sum(weight[s] for s in free)
        full = [s for s in free if left * weight[s] > cap[s] * total]
        if not full:
            out |= {s: left * weight[s] / total for s in free}
            break
        out |= {s: cap[s] for s in full}
        left -= sum(cap[s] for s in full)
        free = [s for s in free if s not in out]
    return {s: float(out[s]) for s in names}


def flight(p: np.ndarray, size: np.ndarray, draw: np.random.Generator, words_only: bool = False, leave: int = 0) -> np.ndarray:
    """Move probabilities until at most `leave` units, or units among which nothing can be balanced, stay fractional.

    Keeps the sum of p * size and, unless words_only, the sum of p.  Units come with large sizes first: each in turn
    moves against all fractional units after it, in proportion to their room p * (1 - p), until it or one of them lands.
    """
    p, size = np.array(p, float), np.array(size, float)
    for i in range(len(p)):
        while EPSILON < p[i] < 1 - EPSILON:
            q, s = p[i + 1 :], size[i + 1 :]
            room = np.where((q > EPSILON) & (q < 1 - EPSILON), q * (1 - q), 0.0)
            by_size = room * s
            sums = room.sum(), by_size.sum(), (by_size * s).sum()
            det = sums[0] * sums[2] - sums[1] ** 2
            if not sums[0] or leave and np.count_nonzero(room) < leave:
                return p
            if not words_only and det > 1e-9 * sums[0] * sums[2]:
                step = -((sums[2] - size[i] * sums[1]) * room + (size[i] * sums[0] - sums[1]) * by_size) / det
            elif words_only or (s[room > 0] == size[i]).all():
                step = -size[i] / sums[2] * by_size
            else:
                return p
            moved = step != 0
            way, far = step[moved], q[moved]
            up = min(1 - p[i], (np.where(way > 0, 1 - far, far) / np.abs(way)).min(initial=np.inf))
            down = min(p[i], (np.where(way > 0, far, 1 - far) / np.abs(way)).min(initial=np.inf))
            move = up if draw.random() * (up + down) < down else -down
            p[i] += move
            q += move * step
            p[p < EPSILON], p[p > 1 - EPSILON] = 0.0, 1.0
    return p


def landing(p: np.ndarray, size: np.ndarray, draw: np.random.Generator) -> np.ndarray:
    """Land the last fractional units, and only those.

    The document total is given up first, by a flight that balances words alone and leaves LAND units; of all ways to
    land these the one is taken whose words come nearest to what their probabilities stand for, then whose documents do,
    then the first.
    """
    p = flight(p, size, draw, words_only=True, leave=LAND)
    left = np.flatnonzero((p > EPSILON) & (p < 1 - EPSILON))
    ways = (np.arange(1 << len(left))[:, None] >> np.arange(len(left))) & 1
    off = np.abs(ways @ size[left] - p[left] @ size[left]), np.abs(ways.sum(axis=1) - p[left].sum())
    p[left] = ways[np.lexsort((off[1], off[0].round(6)))[0]]
    return p


def _draw(*key: object) -> np.random.Generator:
    return np.random.default_rng(int.from_bytes(blake2b(repr(key).encode(), digest_size=8).digest(), "big"))


def _flown(units: DataFrame, level: int, seed: int, last: bool) -> DataFrame:
    """Fly (and on the last level land) each block of units (source, rank, uid, size, p)."""

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("size", "descending"), ("uid", "ascending")])
        size, draw = rows["size"].to_numpy().astype(float), _draw(seed, level, *(k.as_py() for k in key))
        p = flight(rows["p"].to_numpy(), size, draw, leave=3 * LAND if last else 0)
        return rows.set_column(rows.column_names.index("p"), "p", pa.array(landing(p, size, draw) if last else p, pa.float64()))

    return units.groupBy("source", "block").applyInArrow(run, "source string, block long, uid string, size long, p double")


def copies(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST, block: int = BLOCK, seed: int = 0) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, n_copies, taken (= n_copies * size).

    size counts the words of the text; a null or blank text has none and is not taken.  Sources are ordered by code
    point, null last, and weigh `weights`, repeating; they share `share` times all words, and what exceeds `most` times a
    source's words is reshared by weight.  Reruns agree: all draws come from hashes of the rows.  Rows equal in doc_id,
    source and size are told apart by a running number only, so they get the same number of copies as a group however
    they are stored; an empty table gives an empty result; other columns are ignored.
    """
    sized = keep(docs.select("doc_id", "source", words().alias("size")))
    return _copies(sized, weights, share, most, block, seed).select("doc_id", "size", "source_size", "target", "n_copies", (F.col("n_copies") * F.col("size")).alias("taken"))


def _copies(sized: DataFrame, weights: tuple[float, ...], share: float, most: float, block: int, seed: int) -> DataFrame:
    spark = sized.sparkSession
    # a row for each source, twice on the driver: names and sums
    totals = {r["source"]: (r["words"] or 0, r["n"]) for r in sized.groupBy("source").agg(F.sum("size").alias("words"), F.count("*").alias("n")).collect()}
    goal = targets({s: w for s, (w, _) in totals.items()}, weights, share, most)
    # local rows, so that Spark knows their size and broadcasts them only below its threshold
    schema = pa.schema({"of": pa.string(), "source_size": pa.int64(), "target": pa.float64(), "ratio": pa.float64(), "n": pa.int64()})
    per_source = local(spark, [(s, w, goal[s], goal[s] / w if w else 0.0, n) for s, (w, n) in totals.items()], schema)

    named = sized.groupBy("doc_id", "source", "size").agg(F.count("*").alias("same"))
    named = named.join(per_source, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    named = named.withColumn("fixed", F.floor("ratio")).withColumn("part", F.col("ratio") - F.col("fixed"))
    units = (
        named.filter((F.col("size") > 0) & (F.col("part") > EPSILON))
        .select("source", F.explode(F.sequence(F.lit(1), F.col("same").cast("int"))).alias("k"), F.col("doc_id"), "size", F.col("part").alias("p"), "n")
        .withColumn("uid", F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "k"))
    )
    left = units.withColumn("block", F.pmod(F.xxhash64("uid", "size", F.lit(seed)), F.ceil(F.col("n") / block))).select("source", "block", "uid", "size", "p")
    counts = {s: n for s, (_, n) in totals.items()}
    landed, level = None, 0
    while True:
        last = max([0, *counts.values()]) <= block
        flown = keep(_flown(left, level, seed, last))
        done = flown.filter((F.col("p") <= EPSILON) | (F.col("p") >= 1 - EPSILON)).filter("p > 0.5").select("source", "uid", "size")
        landed = done if landed is None else landed.unionByName(done)
        if last:
            break
        left = flown.filter((F.col("p") > EPSILON) & (F.col("p") < 1 - EPSILON))
        level += 1
        counts = {r["source"]: r["n"] for r in left.groupBy("source").agg(F.count("*").alias("n")).collect()}
        left = left.join(local(spark, list(counts.items()), pa.schema({"of": pa.string(), "n": pa.int64()})), F.col("source").eqNullSafe(F.col("of")))
        left = left.withColumn("block", F.pmod(F.xxhash64("uid", "size", F.lit(seed + level)), F.ceil(F.col("n") / block))).select("source", "block", "uid", "size", "p")

    # rows alike in all three are told apart by a number only, so a count of those that landed on 1 is enough
    extra = landed.groupBy(F.col("source").alias("of"), F.substring_index("uid", ":", 1).alias("id"), F.col("size").alias("long")).agg(F.count("*").alias("more"))
    same = F.col("n_id").eqNullSafe(F.col("id")) & F.col("source").eqNullSafe(F.col("of")) & (F.col("size") == F.col("long"))
    rows = named.withColumn("n_id", F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).join(extra, same, "left")
    rows = rows.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("same").cast("int"))))
    once = (F.col("k") <= F.coalesce("more", F.lit(0))).cast("int")
    return rows.withColumn("n_copies", F.when(F.col("size") > 0, F.col("fixed") + once).otherwise(0).cast("long"))


def mixed(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST, block: int = BLOCK, seed: int = 0) -> DataFrame:
    """The mix itself: every document as often as it is taken, numbered by copy_no from 1, with all its other columns.

    The rows are as many as the copies that `copies` gives.  A null or blank text has no words and is not taken; rows
    equal in doc_id, source and size share their group's copies, in the order of a hash of the whole row; a column named
    copy_no is replaced; an empty table gives an empty result.
    """
    sized = keep(docs.select("doc_id", "source", words().alias("size")))
    plan = _copies(sized, weights, share, most, block, seed).filter("n_copies > 0 or same > 1")
    plan = plan.select(F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("size").alias("_size"), "same", "k", "n_copies")
    again = sized.groupBy(F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("size").alias("_size")).agg(F.count("*").alias("same")).filter("same > 1").drop("same")
    again = stored(again.select("_id", "_source", "_size"), "again")
    key = F.col("doc.doc_id").eqNullSafe(F.col("_id")) & F.col("doc.source").eqNullSafe(F.col("_source")) & (F.col("size") == F.col("_size"))
    rows = docs.select(F.struct("*").alias("doc"), words().alias("size"))
    if again.isEmpty():
        taken = rows.join(plan, key)
    else:
        # the few rows that repeat are numbered; all others need no window
        same = W.partitionBy("_id", "_source", "_size").orderBy(F.xxhash64("doc"))
        numbered = rows.join(again, key).withColumn("place", F.row_number().over(same)).select("doc", "size", "place")
        taken = rows.join(plan.filter("same = 1"), key).select("doc", "n_copies").unionByName(numbered.join(plan.filter("same > 1"), key & (F.col("place") == F.col("k"))).select("doc", "n_copies"))
    taken = taken.filter("n_copies > 0").withColumn("copy_no", F.explode(F.sequence(F.lit(1), F.col("n_copies").cast("int"))))
    return taken.select(*(F.col("doc").getField(c).alias(c) for c in docs.columns if c != "copy_no"), "copy_no")
