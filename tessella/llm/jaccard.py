"""N-gram Jaccard join over a token-group matrix.

Documents are sets of hashed 5-word shingles.  Similar sets are partitioned into groups first, around centres that the
holders of a token agree on; the matrix then holds, for each group, the union of its members' tokens.  A query set opens
a group only if its overlap with that union can still reach the threshold, so no link between different sets is lost and
copies are never expanded into pairs.

Every stage is bounded by what it joins on: exact copies collapse to one set, postings are linked to a few centres
instead of to each other, groups have bounded parts, and the tokens that many documents share are sorted behind the rare
ones by a corpus-wide frequency sketch of fixed size.  Any order of tokens gives the same result; the sketch only makes
postings short.  The tokens of a set move three times: to be named once, to its group, and to those that open it.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import bloom, components, forget, in_bloom, released, stored
from .words import all_shingles, set_id, shingles

#: Orders (masks of a set's name) whose first and last holder of a token are centres to try; more only save work later.
ORDERS = (0, 0x5A5A5A5A5A5A5A5A)
#: Sets and tokens of a group, and queries that a task holds beside it; longer sets are a group of their own.
PART, PART_TOKENS, QUERIES = 512, 1 << 18, 1024
#: Times that a home is replaced by its own home, which brings sets together that agree on centres by way of others.
JUMPS = 2
#: A token held in more groups than this is left out of a query, as long as the rest of the query can decide.
WIDE = 16
#: Cells of the frequency sketch; the driver and each worker hold this many counts, however large the corpus.
SKETCH_BITS = 18
#: One token in so many of a set is shared by the extended prefixes of linked sets.
SHARED = 20


def _shared(n: int) -> int:
    """Tokens that the extended prefixes of two linked sets of at least n tokens must share."""
    return max(1, n // SHARED)


def _needed(n: str, percent: int) -> Column:
    """Tokens that a set of n shares in this way with each set that it links to, the smallest of which has percent of n."""
    return F.expr(f"greatest(1L, cast(floor(ceil({percent} * {n} / 100) / {SHARED}) as bigint))")


def _sketch(docs: DataFrame, k: int) -> np.ndarray:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(1 << SKETCH_BITS, np.int64)
        for batch in batches:
            cells += np.bincount((all_shingles(batch.column(0), k) >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=1 << SKETCH_BITS)
        (full,) = np.nonzero(cells)
        yield pa.RecordBatch.from_arrays([pa.array(full.astype(np.int32)), pa.array(cells[full])], ["cell", "n"])

    with released(docs.sparkSession):
        rows = docs.select("text").mapInArrow(count, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(1 << SKETCH_BITS, np.int64)
    out[rows["cell"].to_numpy()] = rows["n"].to_numpy()
    return out


def _lists(lists: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, lists)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(lists).view(np.int64) if lists else np.zeros(0, np.int64)))


def _prefixes(docs: DataFrame, k: int, percent: int, ranks: np.ndarray) -> DataFrame:
    """(doc_id, h, set_id, n, prefix): the rarest tokens, of which linked sets share some; listed once a task for each set.

    h tells the texts of a doc_id apart.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            ids, counts, lists = [], [], []
            for tokens in shingles(batch.column(2), k):
                n, name = len(tokens), set_id(tokens)
                ids.append(name)
                counts.append(n)
                if not n or name in seen:
                    lists.append(tokens[:0])
                    continue
                seen.add(name)
                size = min(n, n - ceil(percent * n / 100) + _shared(n))
                rank = ranks[(tokens >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
                # tokens come sorted, so a stable sort breaks ties by token
                lists.append(tokens[np.argsort(rank, kind="stable")[:size]])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ids, pa.int64()), pa.array(counts, pa.int64()), _lists(lists)], ["doc_id", "h", "set_id", "n", "prefix"])

    return docs.select("doc_id", F.xxhash64("text").alias("h"), "text").mapInArrow(run, "doc_id long, h long, set_id long, n long, prefix array<long>")


def _tokens(docs: DataFrame, k: int, homes: DataFrame) -> DataFrame:
    """The homes with their sets' tokens; a bitmap of bounded size keeps most other sets out of the shuffle."""
    bitmap = bloom(homes.filter("not guest"), "set_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            ids, lists = [], []
            for tokens in shingles(batch.column(0), k):
                name = set_id(tokens)
                if name not in seen and in_bloom(bitmap, np.array([name]))[0]:
                    seen.add(name)
                    ids.append(name)
                    lists.append(tokens)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), _lists(lists)], ["set_id", "tokens"])

    found = docs.select("text").mapInArrow(run, "set_id long, tokens array<long>")
    return found.groupBy("set_id").agg(F.first("tokens").alias("tokens")).join(homes, "set_id")


def _classes(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """(doc_id, h, n, component_id, component) of all rows, written out; component tells those of one component_id apart,
    which there are if a doc_id repeats, and is null for blank texts."""
    prefixes = stored(_prefixes(docs, k, percent, _sketch(docs, k)), "prefixes")
    rows = stored(prefixes.select("doc_id", "h", "set_id", "n"), "rows")
    sets = rows.filter("n > 0").groupBy("set_id").agg(F.min("doc_id").alias("rep"), F.max("n").alias("n"))

    # tokens that another set has too, of sets that have enough of them; both sides of the semi-join read one shuffle
    listed = prefixes.filter("size(prefix) > 0").select("set_id", F.explode("prefix").alias("token"))
    met = (F.col("x.token") == F.col("y.token")) & (F.col("x.set_id") != F.col("y.set_id"))
    shared = listed.alias("x").join(listed.alias("y"), met, "left_semi").groupBy("set_id").agg(F.collect_set("token").alias("tokens"))
    held = stored(shared.join(sets.select("set_id", "n"), "set_id").withColumn("need", _needed("n", percent)).filter("size(tokens) >= need"), "held")
    forget(prefixes)

    homes = stored(_homes(held), "homes")
    tokens = stored(_tokens(docs, k, homes), "tokens")
    grouped = homes.groupBy("grp").agg(F.count("*").alias("sets")).filter("sets > 1").select("grp")
    links = stored(_opened(tokens.select("grp", F.lit(0).alias("share"), "set_id", F.lit(True).alias("asks"), F.lit(True).alias("inside"), "centre", "guest", "tokens").join(grouped, "grp"), percent), "links")
    # all that links to a centre has its name in each part of its group: parts of components, without a round of joins
    near = links.select(F.col("u").alias("node"), F.col("v").alias("component"))

    asked = stored(_asked(held, homes, near), "asked")
    more = stored(_opened(_queries(asked, homes.filter("not guest"), tokens.filter("not guest")), percent), "links")
    joined = components(links.unionByName(more))
    named = sets.join(joined, F.col("set_id") == F.col("node"), "left").select("set_id", "rep", F.coalesce("component", "set_id").alias("component"))
    least = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = named.join(least, "component").select("set_id", "component_id", "component")
    out = rows.join(named, "set_id", "left").select("doc_id", "h", "n", "component", F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
    out = stored(out, "classes")
    forget(rows, held, homes, tokens, links, asked, more)
    return out


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the smallest doc_id reachable by links).

    Two documents link when 100 * |intersection| >= percent * |union| of their shingle sets.  A null or blank text is
    the empty set: it links with nothing and is its own component.  Repeated rows, equal texts and rows that share a
    doc_id each get a row; they meet in one component by their set.  A null doc_id never names a component unless all
    of its members have none.  Other columns of the input are ignored.  An empty table gives an empty result.  Tokens
    and sets are compared by 64-bit hashes.
    """
    return _classes(docs, k, percent).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def _homes(held: DataFrame) -> DataFrame:
    """(set_id, grp, centre, guest): the group of each set, and once more the centres as guests of the parts they are not in.

    A set's home is the least of itself and the centres that it shares enough tokens with, else the one that it shares
    most with, or a home's home; a token's centres are the ends of a few orders of its holders, by their hashed names.
    """
    of_token = held.select("set_id", "need", F.explode("tokens").alias("token"))
    name = F.col("set_id")
    ends = [f(name.bitwiseXOR(F.lit(x))).bitwiseXOR(F.lit(x)) for x in ORDERS for f in (F.min, F.max)]
    centres = of_token.groupBy("token").agg(*(e.alias(f"c{j}") for j, e in enumerate(ends))).filter("c0 <> c1")
    found = F.explode(F.array_distinct(F.array(*(f"c{j}" for j in range(len(ends))))))
    pairs = of_token.join(centres, "token").select("set_id", "need", found.alias("v")).filter("v < set_id")
    pairs = pairs.groupBy("set_id", "v").agg(F.count("*").alias("both"), F.max("need").alias("need"))
    best = pairs.groupBy("set_id").agg(F.coalesce(F.min(F.when(F.col("both") >= F.col("need"), F.col("v"))), F.max_by("v", F.struct("both", -F.col("v")))).alias("v"))
    sets = stored(held.select("set_id", "n").join(best, "set_id", "left").select("set_id", "n", F.coalesce("v", "set_id").alias("home")), "sets")
    for _ in range(JUMPS):
        before, up = sets, sets.select(F.col("set_id").alias("at"), F.col("home").alias("up"))
        sets = stored(sets.join(up, F.col("home") == F.col("at")).select("set_id", "n", F.col("up").alias("home")), "sets")
        forget(before)
    size = sets.groupBy("home").agg(F.ceil(F.count("*") / PART).alias("many"), F.ceil(F.sum("n") / PART_TOKENS).alias("long"))
    sets = sets.join(size, "home").withColumn("grp", F.xxhash64("home", F.pmod(F.xxhash64("set_id"), F.greatest("many", "long"))))
    guests = sets.filter("set_id <> home").select(F.col("home").alias("set_id"), "grp", F.lit(True).alias("centre"), F.lit(True).alias("guest")).distinct()
    every = sets.select("set_id", "grp", (F.col("set_id") == F.col("home")).alias("centre"), F.lit(False).alias("guest")).unionByName(guests)
    return every.groupBy("set_id", "grp").agg(F.max("centre").alias("centre"), F.min("guest").alias("guest"))


def _asked(held: DataFrame, homes: DataFrame, near: DataFrame) -> DataFrame:
    """(set_id, other): the groups that a set must open, asked for from one side of two groups.

    A set and its partner in another group share at least `need` of their listed tokens.  Of these the set leaves out
    those that more than WIDE groups hold, but not so many that none would be left, and opens the groups whose union has
    as many of the rest as it then needs.  Members of its own component are no reason to open a group.
    """
    named = held.join(homes.filter("not guest").select("set_id", "grp"), "set_id").join(near, F.col("set_id") == F.col("node"), "left")
    named = stored(named.select(F.explode("tokens").alias("token"), "set_id", "need", "grp", "component"), "named")
    matrix = named.select("token", F.col("grp").alias("other"), F.col("component").alias("c")).distinct()
    wide = matrix.groupBy("token").agg(F.count("*").alias("wide"), F.min("other").alias("lo"), F.max("other").alias("hi")).filter("lo < hi").select("token", "wide")
    of_set = W.partitionBy("set_id")
    query = named.join(wide, "token").withColumn("place", F.row_number().over(of_set.orderBy(F.desc("wide"), "token")))
    query = query.withColumn("out", (F.col("wide") > WIDE) & (F.col("place") < F.col("need")))
    query = query.withColumn("need", F.col("need") - F.count_if("out").over(of_set)).filter("not out").select("token", "set_id", "need", "grp", "component")
    apart = (F.col("other") > F.col("grp")) & (F.col("c").isNull() | F.col("component").isNull() | (F.col("c") != F.col("component")))
    asked = query.join(matrix, "token").filter(apart).groupBy("set_id", "other", "c").agg(F.count("*").alias("both"), F.max("need").alias("need"))
    out = stored(asked.filter("both >= need").select("set_id", "other").distinct(), "asked")
    forget(named)
    return out


def _queries(asked: DataFrame, homes: DataFrame, tokens: DataFrame) -> DataFrame:
    """What each task compares: a group, bounded by PART sets and about PART_TOKENS tokens, and a bounded part of its queries."""
    counts = asked.groupBy("other").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("shares"))
    queries = asked.join(counts, "other").select(F.col("other").alias("grp"), F.pmod(F.xxhash64("set_id"), F.col("shares")).cast("int").alias("share"), "set_id", F.lit(True).alias("asks"))
    members = homes.join(counts, F.col("grp") == F.col("other")).select("grp", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"), "set_id", F.lit(False).alias("asks"))
    wanted = stored(queries.unionByName(members), "queries")
    rows = wanted.join(_passed(tokens.select("set_id", "tokens"), bloom(wanted, "set_id")), "set_id")
    return rows.select("grp", "share", "set_id", "asks", (~F.col("asks")).alias("inside"), F.lit(False).alias("centre"), F.lit(False).alias("guest"), "tokens")


def _passed(tokens: DataFrame, bitmap: np.ndarray) -> DataFrame:
    """The sets that the bitmap may hold: few of all sets open groups or are opened, and only these are shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(in_bloom(bitmap, batch.column(0).to_numpy())))

    return tokens.mapInArrow(run, "set_id long, tokens array<long>")


def _opened(rows: DataFrame, percent: int) -> DataFrame:
    """(u, v) of each set that is linked in its group: v is the centre, if links between those that ask and those inside
    lead to it, else the least set that they lead to.

    So a task writes a row for each of its sets at most, never the pairs of copies; guests have their row elsewhere.  Sets
    that link to the centre are joined by it and need not be compared with each other.
    """

    def run(key: tuple, table: pa.Table) -> pa.Table:
        names, asks, inside, centre, guest = (table[c].to_numpy() for c in ("set_id", "asks", "inside", "centre", "guest"))
        lists = table["tokens"].combine_chunks() if isinstance(table["tokens"], pa.ChunkedArray) else table["tokens"]
        flat, ends = lists.values.to_numpy(), lists.offsets.to_numpy()
        sizes = np.diff(ends)
        tokens = lambda i: flat[ends[i] : ends[i + 1]]
        members = np.flatnonzero(inside)
        held = np.concatenate([tokens(i) for i in members]) if len(members) else flat[:0]
        owner = np.repeat(np.arange(len(members)), sizes[members])
        order = np.argsort(held, kind="stable")
        owner = owner[order]
        union, first = np.unique(held[order], return_index=True)
        last = np.append(first[1:], len(held))
        # the first in this order of those that are linked names them all
        rank = np.empty(len(names), np.int64)
        rank[np.lexsort((names, ~centre))] = np.arange(len(names))
        root = list(range(len(names)))

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = x = root[root[x]]
            return x

        done = np.zeros(len(names), bool)
        for q in np.argsort(~centre, kind="stable"):
            if not asks[q] or done[q]:
                continue
            own = tokens(q)
            at = np.minimum(np.searchsorted(union, own), max(len(union) - 1, 0))
            at = at[union[at] == own] if len(union) else at[:0]
            if 100 * len(at) < percent * len(own):
                continue  # even the group's union covers too little of it
            a, n = first[at], last[at] - first[at]
            spots = np.repeat(a - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(n.sum())
            both = np.bincount(owner[spots], minlength=len(members))
            partners = members[100 * both >= percent * (len(own) + sizes[members] - both)]
            if centre[q]:
                done[partners] = True
            for i in partners.tolist():
                x, y = sorted((find(int(q)), find(i)), key=rank.__getitem__)
                root[y] = x
        top = np.array([find(i) for i in range(len(names))], np.int64)
        out = np.flatnonzero((np.bincount(top, minlength=len(names))[top] > 1) & ~guest)
        return pa.table({"u": pa.array(names[out], pa.int64()), "v": pa.array(names[top[out]], pa.int64())})

    return rows.groupBy("grp", "share").applyInArrow(run, "u long, v long")


def one_of_each(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """One row of each component, that of its smallest doc_id, with all columns; a row without a doc_id stays.

    Rows that share a doc_id are told apart by their texts: unrelated texts of one doc_id both stay, and of those in one
    component the first by a hash of the text.  Of rows equal in doc_id and text the first by a hash of the whole row
    stays.
    """
    classes = _classes(docs, k, percent)
    found = classes.filter("doc_id is not null").groupBy("doc_id", "h", "component_id", "component").agg(F.count("*").alias("same"))
    # the other texts of the doc_id that names a component; blank texts are linked with nothing
    twice = found.filter("component is not null and doc_id = component_id").groupBy("component").agg(F.min("h").alias("kept"), F.count("*").alias("texts")).filter("texts > 1")
    beside = found.join(twice, "component").filter("doc_id = component_id and h <> kept").select("doc_id", "h")
    out = found.select("doc_id", "h", (F.col("component_id") != F.col("doc_id")).alias("out")).join(beside.withColumn("beside", F.lit(True)), ["doc_id", "h"], "left")
    out = stored(out.select("doc_id", "h", (F.col("out") | F.coalesce("beside", F.lit(False))).alias("out")), "out")
    # stored, their size is known before the join: while it is small the documents need no shuffle; a doc_id alone names
    # what goes unless one of its texts stays
    of_id = out.groupBy("doc_id").agg(F.min("out").alias("all"), F.max("out").alias("some"))
    gone = stored(of_id.filter("all").select("doc_id").sort("doc_id"), "gone")
    part = stored(out.filter("out").join(of_id.filter("some and not all").select("doc_id"), "doc_id").select("doc_id", "h"), "gone")
    again = stored(found.filter("same > 1").select("doc_id", "h").join(out.filter("not out").select("doc_id", "h"), ["doc_id", "h"]), "again")
    forget(classes, out)
    key = [F.col("doc.doc_id") == F.col("doc_id"), F.xxhash64("doc.text") == F.col("h")]
    left = docs.select(F.struct("*").alias("doc")).join(gone, key[0], "left_anti")
    if not part.isEmpty():
        left = left.join(part, key, "left_anti")
    if not again.isEmpty():
        first = W.partitionBy("doc_id", "h").orderBy(F.xxhash64("doc"))
        several = left.join(again, key).withColumn("place", F.row_number().over(first)).filter("place = 1").select("doc")
        left = left.join(again, key, "left_anti").unionByName(several)
    return left.select(*(F.col("doc").getField(c).alias(c) for c in docs.columns))
