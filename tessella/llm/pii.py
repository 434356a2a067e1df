"""Personal data by candidate gradient boosting, in DataFrame functions only.

High-recall generators propose spans that may overlap.  Boosted trees, fitted on texts made here from number and address
formats and their look-alikes, score each candidate by its format and context; a threshold for each kind, calibrated on
held-out texts, selects what is redacted.  A candidate counts as true in the fit only if it is the whole of the span.
Spans that the strict rules of a kind accept are always kept; what only such a rule proposed and then refused is not.

The trees run as one SQL expression, so scoring stays in generated code.  They are fitted on the driver, anew in each
call, from a bounded number of made candidates.
"""

from __future__ import annotations

import json
import random
import re

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import forget, keep, none_as_empty, stored

KINDS = ("email", "ip", "card", "phone")
#: Made texts that the trees are fitted on; trees and their depth; precision that a threshold must reach when held out.
SAMPLE, TREES, DEPTH, PRECISION = 6000, 20, 4, 0.98
#: Share of each tree's step that is taken; candidates of a leaf's weight at least; cut points tried for a feature.
RATE, LEAST, CUTS = 0.3, 2.0, 32

# The base rules, then wider generators: (kind, base, pattern).  Starts are tied to the start of a run, and repeats are
# possessive or bounded where that cannot change a match, so that no text of any length is searched in quadratic time or
# deep recursion.
GENERATORS = (
    ("email", True, r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    ("ip", True, r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    ("card", True, r"(?<![0-9])[0-9](?:[\x20-]?+[0-9])++"),
    ("phone", True, r"\+[0-9][\x20().0-9-]+[0-9]"),
    ("email", False, r"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]++(?: dot [a-z0-9._%+-]++){0,3}+(?: ?@ ?| ?[\[({] ?(?:at|@) ?[\])}] ?| at )[a-z0-9-]++(?:(?: ?[\[({] ?(?:dot|\.) ?[\])}] ?| dot |\.)[a-z0-9-]++)++"),
    ("card", False, r"(?<![0-9])[0-9]{4}(?:[._/\x20-]{1,2}[0-9]{4}){2,3}(?:[._/\x20-]{1,2}[0-9]{1,3})?(?![0-9])|(?<![0-9])[0-9]{4}[._/\x20-]{1,2}[0-9]{6}[._/\x20-]{1,2}[0-9]{5}(?![0-9])"),
    ("card", False, r"(?<![0-9A-Za-z])[0-9]{12,19}(?![0-9A-Za-z])"),
    ("phone", False, r"(?<![0-9A-Za-z+.@])(?:\([0-9]{1,5}\)[\x20./-]{0,2}|[0-9]{1,6}[\x20./-]{1,2})(?:\([0-9]{1,5}\)[\x20./-]{0,2})?[0-9]{2,8}(?:[\x20./-]{1,2}[0-9]{2,5}){0,4}(?![0-9A-Za-z])"),
    ("ip", False, r"(?<![0-9.])[0-9]{1,3}(?:(?: ?\. ?|\[\.\]|\(\.\))[0-9]{1,3}){3}(?!\.?[0-9])"),
)
#: Marks around what a generator finds.
OPEN, CLOSE = "\x01", "\x02"
#: Code points of context on either side.
CONTEXT = 24
# zeros, a number up to 255, or both; spans have a digit in each part
_PART = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])?"
_IP = rf"^{_PART}(?: ?\. ?{_PART}){{3}}$"

# Words that speak for or against a kind.
CUES = {
    "cue_email": "mail|e-mail|contact|write|reach|schreib|kontakt|escrib|correo|courriel|contacte",
    "cue_phone": "phone|tel|call|mobile|cell|fax|whatsapp|ring|sms|text me|hotline|anruf|ruf|handy|llama|movil|appel|portable",
    "cue_card": "card|visa|credit|debit|payment|pay|master|karte|tarjeta|carte|amex",
    "cue_ip": "ip|server|host|login|address|client|node|ping|router|gateway|adresse",
    "cue_other": "order|invoice|version|release|isbn|issn|sku|serial|ref|build|section|chapter|article|commit|part no|figure|score|page|date|total|price|room|paid|sold|about|from|between|years|born|on the|rechnung|factura|facture",
}


def luhn(digits: Column) -> Column:
    """Whether a string of 12 to 19 digits passes the Luhn check."""
    value = lambda i: F.substring(digits, F.length(digits) - i, 1).cast("int")
    doubled = lambda i: F.when(i % 2 == 1, value(i) * 2 - F.when(value(i) > 4, 9).otherwise(0)).otherwise(value(i))
    total = F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), lambda acc, i: acc + doubled(i))
    return F.when(F.length(digits).between(12, 19), total % 10 == 0).otherwise(False)


def _worth(text: Column) -> tuple[Column, Column]:
    """Whether a text has digits, and signs of an address: without, no generator of numbers, or of addresses, can match."""
    return text.rlike("[0-9]"), text.rlike("(?i)@| at |[\\[({] ?at")


def candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, h, kind, base, start, end, span, before, after): all spans proposed; h tells the texts of a doc_id apart.

    One search of a generator puts marks around its matches; the pieces between marks give texts and places, the lengths
    up to a match being summed over the document.  All of it is linear in the text and the number of matches.
    """
    text = none_as_empty()
    digits, marks = _worth(text)
    # the marks themselves become another control character first, which no generator tells from them
    found = docs.select("doc_id", F.xxhash64("text").alias("h"), F.translate(text, OPEN + CLOSE, "\x03\x03").alias("text"), digits.alias("digits"), marks.alias("marks"))
    marked = [F.when(F.col("marks" if kind == "email" else "digits"), F.regexp_replace("text", pattern, f"{OPEN}$0{CLOSE}")).alias(f"t{g}") for g, (kind, _, pattern) in enumerate(GENERATORS)]
    found = found.select("doc_id", "h", *marked)
    found = found.select("doc_id", "h", *(F.when(F.instr(f"t{g}", OPEN) > 0, F.split(f"t{g}", f"[{OPEN}{CLOSE}]", -1)).alias(f"p{g}") for g in range(len(GENERATORS))))
    spans = [
        F.expr(
            f"coalesce(transform(sequence(0, shiftright(size(p{g}), 1) - 1), i -> named_struct('g', {g}, 'i', i, 'm', p{g}[2 * i + 1], "
            f"'gap', char_length(p{g}[2 * i]), 'before', right(p{g}[2 * i], {CONTEXT}), 'after', left(p{g}[2 * i + 2], {CONTEXT}))), array())"
        )
        for g in range(len(GENERATORS))
    ]
    rows = found.select("doc_id", "h", F.explode(F.concat(*spans)).alias("s")).select("doc_id", "h", "s.*").dropDuplicates(["doc_id", "h", "g", "i"])
    along = W.partitionBy("doc_id", "h", "g").orderBy("i").rowsBetween(W.unboundedPreceding, W.currentRow)
    rows = rows.withColumn("end", F.sum(F.col("gap") + F.char_length("m")).over(along).cast("long"))
    kind = F.element_at(F.array(*(F.lit(k) for k, _, _ in GENERATORS)), F.col("g") + 1)
    base = F.element_at(F.array(*(F.lit(b) for _, b, _ in GENERATORS)), F.col("g") + 1)
    return rows.select("doc_id", "h", kind.alias("kind"), base.alias("base"), (F.col("end") - F.char_length("m")).alias("start"), "end", F.col("m").alias("span"), "before", "after")


FEATURES = ("kind_no", "n_digits", "length", "digit_share", "groups", "luhn", "ip_ok", "plus", "parens", "points", "spaces", "at_sign", "first_digit", "kinds_of_digit", "glued_before", "glued_after", "currency", "longest", "shortest", "first_group", "last_group", "pairs", "opens_0", "dashes", "slashes", "said_at", "last_letters", "year", *CUES)


def featured(rows: DataFrame) -> DataFrame:
    """Candidates with their format and context as numbers, and `strict`: whether the kind's base rule accepts them."""
    span, flag = F.col("span"), lambda c: F.coalesce(c, F.lit(False)).cast("double")
    rows = rows.withColumn("digits", F.regexp_replace("span", "[^0-9]", ""))
    n = F.length("digits")
    rows = rows.withColumn("luhn", flag(luhn(F.col("digits")))).withColumn("ip_ok", flag(span.rlike(_IP)))
    context = F.lower(F.concat("before", F.lit(" "), "after"))
    cells = {
        "kind_no": F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("double"), "n_digits": n.cast("double"), "length": F.char_length(span).cast("double"), "digit_share": n / F.greatest(F.char_length(span), F.lit(1)),
        "groups": F.regexp_count(span, F.lit("[0-9]+")).cast("double"), "plus": flag(span.startswith("+")), "parens": flag(span.contains("(")), "points": F.regexp_count(span, F.lit("[.]")).cast("double"),
        "spaces": F.regexp_count(span, F.lit(" ")).cast("double"), "at_sign": flag(span.contains("@")), "first_digit": F.coalesce(F.substring("digits", 1, 1).try_cast("double"), F.lit(-1.0)),
        "kinds_of_digit": F.size(F.array_distinct(F.split("digits", ""))).cast("double"), "glued_before": flag(F.col("before").rlike(r"[A-Za-z0-9_#/=-]$")), "glued_after": flag(F.col("after").rlike(r"^[:A-Za-z0-9_#/=-]")),
        "currency": flag(F.concat(F.right("before", F.lit(3)), F.left("after", F.lit(3))).rlike("[$€£%]")), "longest": F.coalesce(F.array_max(F.transform(F.split(span, "[^0-9]+"), F.length)), F.lit(0)).cast("double"),
    }
    groups = F.transform(F.regexp_extract_all(span, F.lit("[0-9]+"), F.lit(0)), F.length)
    size = lambda c: F.coalesce(c, F.lit(0)).cast("double")
    cells |= {
        "shortest": size(F.array_min(groups)), "first_group": size(F.get(groups, F.lit(0))), "last_group": size(F.try_element_at(groups, F.lit(-1))), "pairs": size(F.size(F.filter(groups, lambda x: x == 2))), "opens_0": flag(span.rlike(r"^\(?0")),
        "dashes": F.regexp_count(span, F.lit("-")).cast("double"), "slashes": F.regexp_count(span, F.lit("/")).cast("double"), "said_at": flag(span.rlike(r"(?i)[\[({] ?(?:at|dot|@|\.) ?[\])}]| dot ")), "last_letters": size(F.length(F.regexp_extract(span, "([A-Za-z]+)$", 1))),
        "year": flag(span.rlike(r"^(?:1[5-9]|20)[0-9]{2}(?![0-9])|(?<![0-9])(?:1[5-9]|20)[0-9]{2}$")),
    }
    cells |= {name: flag(context.rlike(rf"(?<![a-z])(?:{pattern})")) for name, pattern in CUES.items()}
    strict = F.when(F.col("kind") == "email", True).when(F.col("kind") == "ip", F.col("ip_ok") > 0).when(F.col("kind") == "card", F.col("luhn") > 0).otherwise(n.between(9, 15))
    return rows.withColumns(cells).withColumn("strict", F.col("base") & strict)


def _checked(draw: random.Random, digits: str) -> str:
    """The digits with a last one that makes them pass the Luhn check."""
    total = sum(v - 9 * (v > 9) for v in (int(c) * (2 - i % 2) for i, c in enumerate(reversed(digits))))
    return digits + str(-total % 10)


def _made(draw: random.Random) -> list:
    """[text, kind, start, end]: a text around one span, personal data of a kind or a look-alike ('')."""
    d = lambda *widths: ["".join(draw.choice("0123456789") for _ in range(w)) for w in widths]
    sep = draw.choice([" ", "-", ".", "/", " ", "-"])
    octets = draw.choice([[], [], ["10", "0"], ["192", "168"], ["172", "16"], ["10"], ["127", "0", "0"]])
    octets = [*octets, *(str(draw.choice([draw.randrange(256), draw.randrange(20)])) for _ in range(4 - len(octets)))]
    name = draw.choice(["anna", "j.smith", "maria_lopez", "paul", "k-meyer", "info", "luc", "team7", "".join(draw.choice("abcdefgihklmnoprstu") for _ in range(draw.randint(2, 20)))])
    host = draw.choice(["mail", "example", "post", "firma", "uni-x", "".join(draw.choice("abcdeghiklmnorstuvw") for _ in range(draw.randint(2, 14)))])
    ending = draw.choice(["com", "org", "net", "de", "fr", "es", "info", "co", "ch", "museum", "app"])
    number = _checked(draw, draw.choice(["4", "51", "55", "37", "6011", "2221", "9"]) + "".join(d(18)))
    number = _checked(draw, number[: draw.choice([15, 15, 15, 14, 12, 18])])
    wrong = number[:-1] + str((int(number[-1]) + draw.randint(1, 9)) % 10)
    fours = lambda x, by: by.join(x[i : i + 4] for i in range(0, len(x), 4))
    area, year = draw.choice(["0", "", ""]) + str(draw.randint(2, 999)), str(draw.randint(1500, 2059))
    word = draw.choice(["look", "stayed", "arrived", "shout", "is", "was", "people", "waited", "aimed"])
    true = {
        "email": [f"{name} at {host} dot {ending}", f"{name} [at] {host} [dot] {ending}", f"{name} dot {host} at post dot {ending}", f"{name}(at){host}.{ending}", f"{name} @ {host}.{ending}", f"{name} (AT) {host} (DOT) {ending}", f"{name}@{host} dot {ending}", f"{name} at {host}.{ending}", f"{name}{{at}}{host}.{ending}"],
        "ip": [" . ".join(octets), "[.]".join(octets), "(.)".join(octets), ". ".join(octets)],
        "card": [fours(number, draw.choice([".", "/", "_", " - ", "  ", "."])), number, fours(number, "/")],
        "phone": [sep.join(d(3, 3, 4)), f"({d(3)[0]}) {'-'.join(d(3, 4))}", sep.join(["0" + d(1)[0], *d(2, 2, 2, 2)]), f"0{d(2)[0]} {d(8)[0]}", f"0{d(3)[0]}{draw.choice('/-')}{d(draw.choice([6, 7, 8]))[0]}", sep.join(["0" + d(2)[0], *d(4, 4)]), sep.join(["0" + d(3)[0], *d(3, 4)]), f"(0{d(2)[0]}) {' '.join(d(4, 4))}", sep.join(["9" + d(2)[0], *d(3, 3)]), sep.join(["6" + d(2)[0], *d(2, 2, 2)]), f"({area}) {d(7)[0]}", sep.join(["1", *d(3, 3, 4)])],
    }
    false = [
        f"{word} at home dot com", f"{word} at {host}.{ending}", f"{word} at noon.{word}", f"{word} at {host}.The", f"{word} @ {host}.x", f"{d(1)[0]} at {d(1)[0]}.{d(2)[0]}",
        f"{d(1)[0]}. {d(1)[0]}. {d(2)[0]}. {d(1)[0]}", " . ".join(d(1, 1, 1, 2)), ". ".join(str(300 + draw.randrange(600)) for _ in range(4)), ". ".join(d(2, 1, 3, 1)),
        fours(wrong, "."), fours(wrong, "/"), wrong, "/".join(d(4, 4, 4)), fours(wrong, " - "), "".join(d(draw.choice([12, 13, 14, 16]))),
        f"{year}-{draw.randint(1, 12):02d}-{draw.randint(1, 28):02d}", f"{draw.randint(1, 28):02d}.{draw.randint(1, 12):02d}.{year}", f"{draw.randint(1, 28)}/{draw.randint(1, 12)}/{year}", f"{draw.randint(1, 28):02d}.{draw.randint(1, 12):02d}.{year} {draw.randint(0, 23):02d}:{d(2)[0]}", f"{year}-{draw.randint(1, 12):02d}-{draw.randint(1, 28):02d} {draw.randint(0, 23):02d}:{d(2)[0]}:{d(2)[0]}", f"{year}-{draw.randint(1500, 2059)}", f"{year} {d(3)[0]}", f"{d(1)[0]}.{d(7)[0]}", f"{d(2)[0]} {' '.join(d(3, 3))}", f"{d(1)[0]} {' '.join(d(3, 3))}", f"{d(3)[0]} {d(3)[0]}",
        f"{d(3)[0]}.{d(3)[0]}", "-".join(["978", *d(1, 4, 4, 1)]), "-".join(d(4, 4)), "-".join(d(4, 3)), "-".join(d(3, 2, 4)), f"{d(2)[0]}/{'/'.join(d(3, 4))}", f"{d(4)[0]}/{d(5)[0]}", f"{d(5)[0]}-{d(4)[0]}", " ".join(d(2, 2, 2, 2, 2)), " ".join(d(1, 2, 3, 2)), f"{year}{d(4)[0]} {d(4)[0]}", f"{d(6)[0]}.{d(3)[0]}", f"({year}) {d(3)[0]}", f"{d(2)[0]}-{d(2)[0]} {year}",
    ]
    said = {
        "email": ["mail me at ", "contact: ", "write to ", "e-mail ", "reach ", "schreib an ", "correo: "], "ip": ["server ", "host ", "login from ", "ping ", "ip ", "address "], "card": ["card ", "visa ", "my card number is ", "pay with ", "Karte ", "tarjeta "],
        "phone": ["call ", "phone: ", "tel ", "ring ", "mobile ", "my number is ", "Anruf ", "fax ", "text me on ", "appelle "], "": ["order ", "serial ", "invoice ", "version ", "section ", "isbn ", "total of ", "ref ", "build ", "on ", "between ", "from ", "about ", "figure ", "they ", "page ", "price "],
    }
    kind = draw.choice(["", "", "", "", *KINDS, "card", "phone", "phone", "ip"])
    span = draw.choice(true[kind] if kind else false)
    cue = draw.choice(said[kind]) if draw.random() < 0.7 else draw.choice(["", "see ", "and ", "the ", "it is ", "or ", "then "])
    if not kind and draw.random() < 0.1:
        cue = draw.choice(said[draw.choice(KINDS)])
    lead = draw.choice(["", "The plan: ", "As said, ", "Well, ", "Yesterday we met and ", "Bitte ", "Por favor, "]) + cue
    after = draw.choice([".", " and so on.", ", please.", " today", "", " (new)", " ok", "\nNext", " or later", "!"])
    return [lead + span + after, kind, len(lead), len(lead) + len(span)]


def _made_texts(spark: SparkSession, n: int, seed: int = 1) -> DataFrame:
    """(doc_id, text, truth, from, to): n texts that hold one span each, personal data of a kind or a look-alike (truth '')."""
    draw = random.Random(seed)
    rows = [dict(zip(("doc_id", "text", "truth", "from", "to"), (i, *_made(draw)), strict=True)) for i in range(n)]
    schema = "array<struct<doc_id:long,text:string,truth:string,from:long,to:long>>"
    return spark.range(1).select(F.explode(F.from_json(F.lit(json.dumps(rows)), schema)).alias("r")).select("r.*")


def _tree(bins: np.ndarray, cuts: list[np.ndarray], slope: np.ndarray, curve: np.ndarray, rows: np.ndarray, depth: int) -> tuple | float:
    """A regression tree by second-order gains: (feature, cut, tree up to the cut, tree above), or a leaf's value."""
    g, h = slope[rows].sum(), curve[rows].sum()
    best = (1e-6, -1, -1)
    if depth and h > 2 * LEAST:
        for f, points in enumerate(cuts):
            if len(points):
                left_g, left_h = (np.cumsum(np.bincount(bins[rows, f], x[rows], len(points) + 1))[:-1] for x in (slope, curve))
                gain = left_g**2 / (left_h + 1) + (g - left_g) ** 2 / (h - left_h + 1) - g**2 / (h + 1)
                gain[(left_h < LEAST) | (h - left_h < LEAST)] = -1.0
                k = int(np.argmax(gain))
                best = max(best, (float(gain[k]), -f, -k))
    if best[0] <= 1e-6:
        return float(RATE * g / (h + 1))
    f, k = -best[1], -best[2]
    low = bins[rows, f] <= k
    return f, float(cuts[f][k]), *(_tree(bins, cuts, slope, curve, x, depth - 1) for x in (rows[low], rows[~low]))


def _as_sql(tree: tuple | float) -> str:
    if isinstance(tree, float):
        return f"{tree!r}D"
    feature, cut, low, high = tree
    return f"CASE WHEN {FEATURES[feature]} <= {cut!r}D THEN {_as_sql(low)} ELSE {_as_sql(high)} END"


def _value(tree: tuple | float, x: np.ndarray) -> np.ndarray:
    if isinstance(tree, float):
        return np.full(len(x), tree)
    feature, cut, low, high = tree
    return np.where(x[:, feature] <= cut, _value(low, x), _value(high, x))


def _boosted(x: np.ndarray, y: np.ndarray, trees: int, depth: int) -> list[tuple | float]:
    """Trees boosted on the logistic loss."""
    cuts = [np.unique(np.quantile((u[1:] + u[:-1]) / 2, np.linspace(0, 1, CUTS), method="nearest")) if len(u := np.unique(c)) > 1 else u[:0] for c in x.T]
    bins = np.stack([np.searchsorted(points, c, "left") for points, c in zip(cuts, x.T, strict=True)], axis=1)
    total, out = np.zeros(len(y)), []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        out.append(_tree(bins, cuts, y - p, p * (1 - p), np.arange(len(y)), depth))
        total += _value(out[-1], x)
    return out


def fit(spark: SparkSession, n: int = SAMPLE, trees: int = TREES, depth: int = DEPTH, precision: float = PRECISION) -> tuple[str, dict[str, float]]:
    """The boosted trees as a SQL expression over FEATURES, and the score that a candidate of each kind must reach.

    Depends on the parameters alone: no row of any table is learned from.  The driver holds the candidates of n texts.
    """
    made = keep(_made_texts(spark, n))
    y = (F.col("truth") == F.col("kind")) & (F.col("start") == F.col("from")) & (F.col("end") == F.col("to"))
    found = keep(candidates(made).filter("not base"))
    rows = featured(found).join(made.select("doc_id", "truth", "from", "to"), "doc_id")
    rows = rows.select("kind", y.cast("double").alias("y"), (F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0).alias("held"), F.array(*FEATURES).alias("x"), "doc_id", "start", "end")
    rows = sorted(rows.collect(), key=lambda r: (r["doc_id"], r["start"], r["end"], r["kind"]))
    forget(made, found)
    kind, held = np.array([r["kind"] for r in rows]), np.array([r["held"] for r in rows])
    x, y = np.array([r["x"] for r in rows]), np.array([r["y"] for r in rows])
    model = _boosted(x[~held], y[~held], trees, depth)
    score = f"1D / (1D + exp(-({' + '.join(map(_as_sql, model))})))"
    scored = 1 / (1 + np.exp(-sum(_value(tree, x[held]) for tree in model)))
    limits = {}
    for name in KINDS:
        # the lowest score above which held-out candidates are right often enough
        own = kind[held] == name
        order = np.argsort(-scored[own], kind="stable")
        s, right = scored[own][order], np.cumsum(y[held][own][order])
        ends = np.flatnonzero((right >= precision * np.arange(1, len(s) + 1)) & np.append(s[1:] < s[:-1], True)) if len(s) else np.zeros(0, int)
        limits[name] = max(0.5, float(s[ends[-1]]) - 1e-9) if len(ends) else 0.99
    return score, limits


def spans(docs: DataFrame, model: tuple[str, dict[str, float]] | None = None) -> DataFrame:
    """(doc_id, h, kind, start, end, base, score) of all personal data; code points, end exclusive.

    Spans of the base rules always stand.  Others must reach their kind's score and overlap no base span; of those that
    overlap each other, directly or in a chain, the best by score, then length, then place is taken first, then the best
    of what does not overlap it, and so on.
    """
    score, limits = model or fit(docs.sparkSession)
    # candidates are few beside the texts; stored, their features are not written out again in each tree of the score
    rows = featured(keep(candidates(docs))).filter("strict or not base")
    rows = keep(rows.select("doc_id", "h", "kind", "start", "end", "strict", *FEATURES))
    rows = rows.select("doc_id", "h", "kind", "start", "end", "strict", F.expr(score).alias("score"))
    limit = F.coalesce(*(F.when(F.col("kind") == k, F.lit(v)) for k, v in limits.items()))
    rows = rows.filter(F.col("strict") | (F.col("score") >= limit)).groupBy("doc_id", "h", "kind", "start", "end").agg(F.max("strict").alias("base"), F.max("score").alias("score"))
    text = W.partitionBy("doc_id", "h").orderBy("start", "end", "kind")
    before, after = text.rowsBetween(W.unboundedPreceding, -1), text.rowsBetween(1, W.unboundedFollowing)
    rows = rows.withColumn("base_end", F.max(F.when(F.col("base"), F.col("end"))).over(before)).withColumn("base_start", F.min(F.when(F.col("base"), F.col("start"))).over(after))
    # a base span that starts at the same place may sort behind: it has a later end
    same = W.partitionBy("doc_id", "h", "start")
    clear = F.coalesce(F.col("base_end") <= F.col("start"), F.lit(True)) & F.coalesce(F.col("base_start") >= F.col("end"), F.lit(True)) & ~F.col("starts_base")
    rows = rows.withColumn("starts_base", F.max("base").over(same)).filter(F.col("base") | clear)
    standing = rows.filter("base").select("doc_id", "h", "kind", "start", "end", "base", "score")
    added = rows.filter("not base")
    apart = F.coalesce(F.max("end").over(before) <= F.col("start"), F.lit(True))
    added = added.withColumn("apart", apart).withColumn("chain", F.count_if("apart").over(text.rowsBetween(W.unboundedPreceding, W.currentRow)))
    best_first = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("worse"), (F.col("start") - F.col("end")).alias("shorter"), "start", "kind", "end", "score")))
    chains = added.groupBy("doc_id", "h", "chain").agg(best_first.alias("spans"))
    taken = F.expr("aggregate(spans, slice(spans, 1, 0), (got, x) -> IF(exists(got, y -> y.start < x.end AND x.start < y.end), got, concat(got, array(x))))")
    chosen = chains.select("doc_id", "h", F.explode(taken).alias("s")).select("doc_id", "h", "s.kind", "s.start", "s.end", F.lit(False).alias("base"), "s.score")
    return standing.unionByName(chosen)


def _listed(condition: Column | None = None) -> Column:
    """kind:start:end of the spans by start, then kind as listed, comma-joined."""
    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    item = F.struct(F.col("start"), order.alias("o"), F.col("end"), F.concat_ws(":", "kind", F.col("start").cast("string"), F.col("end").cast("string")).alias("s"))
    found = F.collect_list(item if condition is None else F.when(condition, item))
    return F.array_join(F.transform(F.array_sort(found), lambda x: x["s"]), ",")


def report(docs: DataFrame, model: tuple[str, dict[str, float]] | None = None) -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added.

    The counts and the digest are of the base spans; spans lists all, n_added those that the trees added.  A null text is
    empty; rows equal in doc_id and text get equal results; other columns are ignored; an empty table gives an empty
    result.
    """
    found = spans(docs, model)
    counts = [F.count_if(F.col("base") & (F.col("kind") == k)).alias(f"n_{k}") for k in KINDS]
    per_text = found.groupBy(F.col("doc_id").alias("d"), F.col("h").alias("g")).agg(*counts, F.count_if(~F.col("base")).alias("n_added"), _listed(F.col("base")).alias("base_spans"), _listed().alias("spans"))
    keys = docs.select("doc_id", F.xxhash64("text").alias("h"))
    out = keys.join(per_text, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("h") == F.col("g")), "left")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return out.select("doc_id", *(zero(f"n_{k}") for k in KINDS), F.sha2(F.coalesce("base_spans", F.lit("")), 256).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"), zero("n_added"))


def redacted(docs: DataFrame, model: tuple[str, dict[str, float]] | None = None) -> DataFrame:
    """The documents with each span replaced by its kind in brackets; other columns, and null texts, stay as they are."""
    found = spans(docs, model)
    text = W.partitionBy("doc_id", "h").orderBy("start", F.desc("end"), "kind")
    reached = F.coalesce(F.max("end").over(text.rowsBetween(W.unboundedPreceding, -1)), F.lit(0).cast("long"))
    found = found.withColumn("from", F.greatest("start", reached)).filter("from < end")
    cuts = found.groupBy(F.col("doc_id").alias("_d"), F.col("h").alias("_g")).agg(F.array_sort(F.collect_list(F.struct("from", "end", "kind"))).alias("_cuts"))
    # stored, their size is known before the join: while they are small the documents need no shuffle
    cuts = stored(cuts, "cuts")
    # the document travels as one value, so that no name of its columns can clash with those added here; texts in which
    # no generator can match take no part in the join
    rows = docs.select(F.struct("*").alias("doc"))
    searched = F.coalesce(_worth(F.col("doc.text"))[0] | _worth(F.col("doc.text"))[1], F.lit(False))
    plain = rows.filter(~searched).select(*(F.col("doc").getField(c).alias(c) for c in docs.columns))
    rows = rows.filter(searched).join(cuts, F.col("doc.doc_id").eqNullSafe(F.col("_d")) & (F.xxhash64("doc.text") == F.col("_g")), "left")
    body = F.expr(
        "CASE WHEN _cuts IS NULL THEN doc.text ELSE concat(array_join(transform(_cuts, (c, i) -> concat("
        "substring(doc.text, cast(IF(i = 0, 0, _cuts[greatest(i - 1, 0)].end) AS int) + 1, cast(c.from - IF(i = 0, 0, _cuts[greatest(i - 1, 0)].end) AS int)), '[', upper(c.kind), ']')), ''), "
        "substring(doc.text, cast(_cuts[size(_cuts) - 1].end AS int) + 1)) END"
    )
    return rows.select(*(body.alias("text") if c == "text" else F.col("doc").getField(c).alias(c) for c in docs.columns)).unionByName(plain)
