"""Benchmark decontamination by template canonicalisation.

Tokens that a question can be re-parameterised in (numbers, names, units) become typed placeholders; windows of the
resulting templates are hash-joined between benchmark items and documents.  A joined window shows which value each slot
of the item has in the document: an alignment counts only if it replaces equal values equally and different names by
different ones, and holds enough words of the item that are no slots.  Windows that are mostly numbers and units are searched for with their values, too, as words.
Documents never enter a shuffle: a fixed-size bitmap of the benchmark's window hashes lets only probable hits out of the
scan.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bloom, in_bloom, keep, stored
from .words import mix, pieces, powers, utf8, word_spans

#: Tokens of a window, and the fewest of an item that is searched for as a template; shorter ones are as they stand.
WINDOW, FEWEST = 8, 5
#: Share of an item's windows that a document must hold, and share of its slots that must be replaced consistently.
COVERAGE, CONSISTENT = 0.5, 0.8
#: Tokens in a row that are a passage of an item, however long it is.
PASSAGE = 13
#: Scripts without spaces, in which each character is a token and a word has about two, and signs that part their tokens.
_UNSPACED, _SIGNS = r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}]", r"[\x{3000}-\x{3004}\x{3008}-\x{3020}\x{FF00}-\x{FF0F}\x{FF1A}-\x{FF20}]"

# Units of measure that may follow a number.
UNITS = (
    "mm cm dm m km in inch inches ft foot feet yd yard yards mi mile miles mg g gram grams kg kilogram kilograms t ton tons tonnes oz lb lbs pound pounds "
    "ml cl l liter liters litre litres gallon gallons s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years "
    "hz khz mhz ghz b kb mb gb tb w kw mw v kv a ma j kj cal kcal k c f pa kpa bar percent degree degrees cent cents dollar dollars usd euro euros eur gbp mph kmh"
).split()

_STEP = np.uint64(0xBF58476D1CE4E5B9)
#: The lane of literal tokens, and the one in which any capital begins a name.
_EXACT, _WIDE = 2, 3
_NUMBER, _NAME, _UNIT = (np.uint64(x) for x in (0x51ED270B7A2F9E3D, 0x2545F4914F6CDD1D, 0x9FB21C651E98DF25))

#: Word bytes: letters, digits, and all of a non-ASCII character.
_BREAK = np.ones(256, bool)
_BREAK[48:58] = _BREAK[65:91] = _BREAK[97:123] = _BREAK[128:] = False
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_LETTER = ~_BREAK & ~_DIGIT
_ENDS = np.zeros(256, bool)
_ENDS[[10, 13, 33, 34, 46, 58, 63]] = True
#: Stands for a point or comma between two digits; no UTF-8 text has this byte.
_JOINER = 255
_LETTER[_JOINER] = False


def _unit_hashes() -> np.ndarray:
    data, offsets = utf8(pa.array(UNITS))
    return np.sort(word_spans(data, offsets, _BREAK)[1])


#: First bytes of the characters of these scripts in UTF-8.
_FAR = np.zeros(256, bool)
_FAR[[0xE0, 0xE1, *range(0xE3, 0xEA), 0xEF, 0xF0]] = True


def _spaced(column: pa.Array) -> pa.Array:
    """The texts with spaces around the characters of scripts that have none."""
    if not _FAR[utf8(column)[0]].any():
        return column
    return pc.replace_substring_regex(pc.replace_substring_regex(column, _SIGNS, " "), f"({_UNSPACED})", r" \1 ")


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets, with _JOINER for a point or comma inside a number."""
    data, offsets = utf8(column)
    data = data.copy()
    inner = data[1:-1]
    inner[((inner == 44) | (inner == 46)) & _DIGIT[data[:-2]] & _DIGIT[data[2:]]] = _JOINER
    return data, offsets


def template(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Literal hash and kind (0 word, 1 number, 2 name, 3 unit, 4 name or first word) of all tokens, and the bounds of the rows.

    A capital first in a sentence, a quote or a line says little: it begins a name or any word.

    Letters of all scripts are lower-cased for the hashes.  That keeps the tokens, though not always their places.
    """
    column = _spaced(column)
    data, offsets = _bytes(column)
    starts = ~_BREAK[data]
    starts[1:] &= _BREAK[data[:-1]]
    heads = offsets[offsets < len(data)]
    starts[heads] = ~_BREAK[data[heads]]
    starts = np.flatnonzero(starts)
    _, words = word_spans(*_bytes(pc.utf8_lower(column)), _BREAK)
    bounds = np.searchsorted(starts, offsets)
    kinds = np.zeros(len(words), np.int8)
    if not len(words):
        return words, kinds, bounds
    first = data[starts]
    letters = np.cumsum(_LETTER[data], dtype=np.int64)
    ends = np.cumsum(_ENDS[data], dtype=np.int64)
    inside = np.append(letters[starts[1:] - 1], letters[-1]) - letters[starts] + _LETTER[first]
    number = _DIGIT[first] & (inside == 0)
    fresh = np.ones(len(words), bool)
    fresh[1:] = ends[starts[1:]] > ends[starts[:-1]]
    fresh[bounds[:-1][bounds[:-1] < len(words)]] = True
    second = data[np.minimum(starts + 1, len(data) - 1)]
    upper = ((first >= 65) & (first <= 90)) | ((first == 0xC3) & (second >= 0x80) & (second <= 0x9E))
    kinds[upper] = np.where(fresh[upper], 4, 2)
    kinds[number] = 1
    units = _unit_hashes()
    found = units[np.minimum(np.searchsorted(units, words), len(units) - 1)] == words
    kinds[1:][found[1:] & number[:-1]] = 3
    return words, kinds, bounds


def _lanes(words: np.ndarray, kinds: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Tokens and which of them are slots, for each lane.

    All placeholders; names left as words, for copies that changed the case; _EXACT, no slots; _WIDE, first words are names
    too, for names that begin a sentence or a line on either side.
    """
    out = []
    for kept in ((1, 2, 3), (1, 3), (), (1, 2, 3, 4)):
        tokens, slots = words.copy(), np.isin(kinds, kept)
        for kind, value in ((1, _NUMBER), (2, _NAME), (3, _UNIT), (4, _NAME)):
            tokens[slots & (kinds == kind)] = value
        out.append((tokens, slots))
    return out


def _sums(tokens: np.ndarray, size: int) -> np.ndarray:
    out = np.zeros(max(0, len(tokens) - size + 1), np.uint64)
    for j, factor in enumerate(powers(size, _STEP) if len(out) else ()):
        out += tokens[j : j + len(out)] * factor
    return out


def _rolled(tokens: np.ndarray, sums: np.ndarray, size: int, lane: int, gap: int) -> np.ndarray:
    """Hashes of all windows; the token at `gap`, if that is not -1, may be any."""
    if gap >= 0:
        sums = sums - tokens[gap : gap + len(sums)] * powers(size, _STEP)[gap]
    return mix(sums + np.uint64(128 * (gap + 1) + 8 * size + lane))


def _gaps(tokens: int) -> list[tuple[int, int]]:
    """Windows and gaps in them for the words that are in all windows of an item, which none would be found without."""
    return [(at, p - at) for p in range(max(0, tokens - WINDOW), min(WINDOW, tokens)) if (at := min(max(p - WINDOW // 2, 0), tokens - WINDOW)) >= 0]


def _items(benchmark: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            words, kinds, bounds = template(batch.column(1))
            signs = pc.fill_null(pc.count_substring_regex(batch.column(1), _UNSPACED), 0).to_pylist()
            for item, signs_, a, b in zip(batch.column(0).to_pylist(), signs, bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                size = min(WINDOW, b - a)
                if not size:
                    continue
                passage = PASSAGE * (1 + (2 * signs_ > b - a))
                own, kind = words[a:b], kinds[a:b]
                valued = [int(np.count_nonzero(kind[at : at + size] % 2)) for at in range(b - a - size + 1)]
                worded = sum(x < size for x in valued)
                for lane, (tokens, masked) in enumerate(_lanes(own, kind)):
                    if size < FEWEST and lane != _EXACT:
                        continue
                    sums = _sums(tokens, size)
                    for at, gap in [*((x, -1) for x in range(len(sums))), *(_gaps(b - a) if lane != _EXACT else ())]:
                        slots = masked[at : at + size].copy()
                        slots[gap:][: gap >= 0] = False
                        firm = bool(lane == _EXACT or 2 * np.count_nonzero(slots) <= size)
                        # a window of slots alone says nothing; one of mostly values needs them to say something
                        if size < FEWEST or 2 * valued[at] > size if lane == _EXACT else firm if gap >= 0 else not slots.all():
                            h = int(_rolled(tokens[at : at + size], sums[at : at + 1], size, lane, gap).view(np.int64)[0])
                            known = [at + x for x in np.flatnonzero(~slots).tolist() if x != gap]
                            rows.append((item, at, size, passage, b - a - size + 1, worded, lane, gap, valued[at] < size, firm, h, own[at : at + size].view(np.int64).tolist(), np.flatnonzero(slots).tolist(), np.flatnonzero(slots & (kind[at : at + size] % 2 == 0)).tolist(), known))
            kinds_ = [pa.int64(), *[pa.int32()] * 7, *[pa.bool_()] * 2, pa.int64(), pa.list_(pa.int64()), *[pa.list_(pa.int32())] * 3]
            names = ["item_id", "at", "size", "passage", "windows", "worded", "lane", "gap", "says", "firm", "hash", "literals", "slots", "names", "known"]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds_)], names)

    schema = "item_id long, at int, size int, passage int, windows int, worded int, lane int, gap int, says boolean, firm boolean, hash long, literals array<long>, slots array<int>, names array<int>, known array<int>"
    return benchmark.select("item_id", "text").mapInArrow(run, schema)


def _hits(docs: DataFrame, bitmap: np.ndarray, searched: list[tuple[int, int, int]]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (piece for whole in batches for piece in pieces(whole, 1)):
            words, kinds, bounds = template(batch.column(1))
            which, places, hashes, lists = [], [], [], []
            lanes = _lanes(words, kinds)
            last = None
            for lane, size, gap in searched:
                if last != (lane, size):
                    last, sums = (lane, size), _sums(lanes[lane][0], size)
                rolled = _rolled(lanes[lane][0], sums, size, lane, gap)
                at = np.flatnonzero(in_bloom(bitmap, rolled))
                row = np.searchsorted(bounds, at, "right") - 1
                inside = at + size <= bounds[row + 1]
                at, row = at[inside], row[inside]
                which.append(row)
                places.append(at - bounds[row])
                hashes.append(rolled[at].view(np.int64))
                lists += [words[x : x + size].view(np.int64) for x in at.tolist()]
            ends = np.cumsum([0, *map(len, lists)])
            literals = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(lists) if lists else np.zeros(0, np.int64)))
            which = np.concatenate(which) if which else np.zeros(0, np.int64)
            both = [pa.array(np.concatenate(x) if x else np.zeros(0, np.int64), pa.int64()) for x in (places, hashes)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(which, pa.int64())), *both, literals], ["doc_id", "place", "hash", "found"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, place long, hash long, found array<long>")


def _union(column: str | Column) -> Column:
    return F.array_distinct(F.flatten(F.collect_set(column)))


def contaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, consistent: float = CONSISTENT) -> DataFrame:
    """One row for each document and benchmark item that it holds, whole or re-parameterised.

    Columns: doc_id, item_id, n_windows (of the item), n_found (windows found at consistent alignments), coverage,
    n_replaced (slot values that differ from the item's), first_word.  A pair is returned when at least `coverage` of
    the item's windows are found, or of those that are not numbers and units alone, as a template of such a window would
    be found in any table; n_windows and n_found are of the larger share.  Two more ways need no such share, so coverage may
    be less, 0 even: PASSAGE tokens in a row at one alignment, twice as many in scripts without spaces; and, as one other word hides up to WINDOW tokens, all of the
    item but WINDOW tokens and at least `coverage` of them in found windows, with one other word in a window of an item so
    short that the word is in all of its windows.  An alignment needs as many tokens of the item
    that are no slots as half a window has, so that new values in an item of fewer such tokens, say a bare sum, are not
    found; its copies are.  Items of fewer than FEWEST tokens are
    searched for as they stand, by all their tokens; those shorter than WINDOW are
    one window.  Null or empty texts hold nothing; rows that share a doc_id are reported together, those without one
    under null; repeated items count once; an empty table gives an empty result; other columns are ignored.
    """
    items = keep(_items(benchmark).dropDuplicates(["item_id", "at", "hash"]))
    searched = sorted(tuple(r) for r in items.select("lane", "size", "gap").distinct().collect())  # at most lanes x WINDOW x gaps
    hits = _hits(docs, bloom(items, "hash"), searched)
    slot = lambda i: F.struct(F.col("literals")[i].alias("b"), F.col("found")[i].alias("d"))
    joined = hits.join(items, "hash").withColumn("shift", F.col("place") - F.col("at")).withColumn("pairs", F.transform("slots", slot)).withColumn("named", F.transform("names", slot))
    # each kind of alignment is consistent by itself, so that none makes another fail: of templates, with first words as
    # slots, with gaps, and word for word
    sort = F.when(F.col("gap") >= 0, "gap").when(F.col("lane") == _WIDE, "wide").otherwise("template")
    joined = joined.withColumn("sort", F.explode(F.array_compact(F.array(sort, F.when((F.col("gap") < 0) & (F.col("literals") == F.col("found")), F.lit("same"))))))
    whole, firm = F.col("gap") < 0, F.when(F.col("firm"), F.col("at"))
    aligned = (
        joined.groupBy("doc_id", "item_id", "shift", "sort")
        .agg(
            F.max("windows").alias("windows"), F.max("worded").alias("worded"), F.max("size").alias("size"), F.max(F.col("passage") - WINDOW).alias("more"), F.min("at").alias("least"),
            F.collect_set(F.when(whole, F.col("at"))).alias("at"), F.collect_set(F.when(whole & F.col("says"), F.col("at"))).alias("saying"), F.collect_set(firm).alias("firm"),
            F.sort_array(F.collect_set(F.when(whole, firm))).alias("row"), _union("pairs").alias("pairs"), _union("named").alias("named"), _union("known").alias("known"),
        )
        .withColumn("values", F.size(F.array_distinct(F.transform("pairs", lambda x: x["b"]))))
        # a value with several replacements, or names with one and the same; numbers may come to be equal
        .withColumn("clashes", F.size("pairs") - F.col("values") + F.size("named") - F.size(F.array_distinct(F.transform("named", lambda x: x["d"]))))
        .withColumn("values", F.when(F.col("sort") == "wide", F.size(F.array_distinct(F.transform(F.filter("pairs", lambda x: x["b"] != x["d"]), lambda x: x["b"])))).otherwise(F.col("values")))
        .withColumn("clashing", 100 * F.col("clashes") > (100 - round(100 * consistent)) * F.col("values"))
        .withColumn("good", ~F.col("clashing") & (2 * F.size("known") >= F.col("size")))
    )
    share = lambda found, of: F.struct((F.col(found) / F.greatest(F.col(of), F.lit(1))).alias("coverage"), F.col(found).cast("long").alias("n_found"), F.col(of).cast("long").alias("n_windows"))
    good = lambda x: F.when(F.col("good"), F.col(x))
    return (
        aligned.withColumn("passage", F.exists(F.transform("row", lambda x, i: F.coalesce(F.get("row", i + F.col("more")) == x + F.col("more"), F.lit(False))), lambda x: x))
        .withColumn("tokens", F.flatten(F.transform("firm", lambda x: F.sequence(x, x + F.col("size") - 1))))
        .withColumn("replaced", F.size(F.filter("pairs", lambda x: x["b"] != x["d"])))
        .groupBy("doc_id", "item_id")
        .agg(
            F.max("windows").alias("windows"), F.max("worded").alias("worded"), F.size(_union(good("at"))).alias("found"), F.size(_union(good("saying"))).alias("said"),
            F.max(good("replaced")).cast("long").alias("n_replaced"), F.min(good("shift") + F.col("least")).alias("first_word"),
            F.max(good("passage")).alias("passage"), F.max(F.col("windows") + F.col("size") - 1).alias("length"),
            F.collect_list(F.when(F.col("good"), F.struct("shift", "sort", "tokens"))).alias("parts"), F.collect_set(F.when(F.col("clashing"), F.col("shift"))).alias("clashing"),
        )
        # parts of an alignment that clashes as a whole count only word for word
        .withColumn("parts", F.filter("parts", lambda x: (x["sort"] == "same") | ~F.array_contains("clashing", x["shift"])))
        .withColumn("held", F.size(F.array_distinct(F.flatten(F.transform("parts", lambda x: x["tokens"])))))
        .withColumn("best", F.greatest(share("found", "windows"), share("said", "worded")))
        .filter((F.col("best.coverage") >= coverage) | F.coalesce("passage", F.lit(False)) | ((F.col("held") >= coverage * F.col("length")) & (F.col("held") >= F.col("length") - WINDOW)))
        .select("doc_id", "item_id", "best.n_windows", "best.n_found", "best.coverage", "n_replaced", "first_word")
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no benchmark item, with all their columns.

    A null or empty text holds nothing and stays, as does a row without a doc_id; rows that share a doc_id stay or go
    together; repeated or null items change nothing; an empty benchmark drops nothing; an empty table gives an empty
    result.
    """
    # stored, its size is known before the join: while it is small the documents need no shuffle
    gone = stored(contaminated(docs, benchmark).filter("doc_id is not null").select("doc_id").distinct(), "contaminated")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
