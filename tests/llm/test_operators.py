import hashlib
import random
import re

import pyarrow as pa
import pytest

from tessella.llm import chat, chunks, decontam, hosts, html, jaccard, langid, licenses, mixing, pii, words

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, h string, copy_no int, grp string"
PLACES = "the old river town keeps a small market every week where people from far valleys trade salt wool and stories until late in the evening".split()


def docs(spark, texts, start=0):
    rows = [(start + i, t, "en", f"s{i % 3}", len(t or ""), "x", 9, "g") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def odd(spark):
    """Nulls, blanks, a lone letter, a long text without a break, repeated rows, a shared and a missing id."""
    rows = [(0, None), (1, ""), (2, " \n\t"), (3, "a"), (4, "x" * 200_000), (5, "1" * 60_000), (6, "same text here twice over"), (6, "same text here twice over"), (7, "same text here twice over"), (8, "one"), (8, "two"), (None, "no id at all in this row"), (9, "Zoë naïve 😀 façade")]
    return spark.createDataFrame([(i, t, None, None, None, None, None, None) for i, t in rows], SCHEMA)


def words_of(t):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def made(n, seed, low=1, high=60):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    out = []
    for _ in range(n):
        if out and draw.random() < 0.5:
            w = out[draw.randrange(len(out))].split()
            for _ in range(draw.randint(0, 3)):
                w[draw.randrange(len(w))] = draw.choice(vocabulary)
            out.append(" ".join(w))
        else:
            out.append(" ".join(draw.choice(vocabulary) for _ in range(draw.randint(low, high))))
    return out


@pytest.mark.parametrize("run", [
    lambda d: mixing.copies(d), lambda d: mixing.mixed(d), lambda d: jaccard.near_duplicates(d), lambda d: jaccard.one_of_each(d), lambda d: langid.identify(d), lambda d: langid.accepted(d),
    lambda d: licenses.scan(d), lambda d: chunks.compare_with_edits(d),
    lambda d: decontam.contaminated(d, d.sparkSession.createDataFrame([(0, "a b"), (1, None)], "item_id long, text string")), lambda d: decontam.clean(d, d.sparkSession.createDataFrame([], "item_id long, text string")),
], ids=["copies", "mixed", "near", "one", "identify", "accepted", "licenses", "chunks", "contaminated", "clean"])
def test_odd_rows_and_empty_tables(spark, run):
    run(odd(spark)).collect()
    assert run(odd(spark).limit(0)).collect() == []


def test_odd_pages_and_turns(spark):
    pages = spark.createDataFrame([(1, None, None), (2, "nothing", ""), (3, "http://A.com", "<p>x"), (3, "http://A.com", "<p>x"), (4, "http://h.net/fr/x?y", "<" * 5000), (None, "://", "<div>" * 3000 + "deep")], "page_id long, url string, html string")
    assert html.extract(pages).count() == 6 and html.extract(pages.limit(0)).count() == 0
    got = {(r.page_id, r.host, r.path, r.rule) for r in hosts.judge(pages).collect()}
    assert {(1, "", "", None), (3, "a.com", "", None), (4, "h.net", "/fr/x", "net/fr/")} <= got
    assert hosts.judge(pages.limit(0)).count() == 0
    turns = spark.createDataFrame([(1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, None, None), (None, 5, "GPT", "b"), (2, 1, "system", None)], "conv_id long, turn long, role string, text string")
    assert chat.repaired(turns).count() == 5 and chat.repaired(turns.limit(0)).count() == 0


def test_shingles_in_blocks():
    texts = [*made(40, 1), None, "", "A b", "x" * 50]
    whole = [set(x.tolist()) for x in words.shingles(pa.array(texts))]
    size, words.BLOCK = words.BLOCK, 16
    try:
        assert [set(x.tolist()) for x in words.shingles(pa.array(texts))] == whole
        assert words.count_words(pa.array(texts)).tolist() == [len(words_of(t)) for t in texts]
    finally:
        words.BLOCK = size
    assert [len(x) for x in whole] == [len({tuple(w[i : i + 5]) for i in range(len(w) - 4)}) if len(w := words_of(t)) >= 5 else int(bool(w)) for t in texts]


def test_pieces_hold_all_rows():
    texts = [*made(30, 2), None, "", "x" * 500, "é" * 40]
    size, words.BLOCK = words.BLOCK, 64
    try:
        for some in (texts, texts[:1], [None], []):
            got = list(words.pieces(pa.RecordBatch.from_arrays([pa.array(some, pa.string())], ["text"]), 0))
            assert [t for p in got for t in p.column(0).to_pylist()] == some
            assert all(sum(len((t or "").encode()) for t in p.column(0).to_pylist()[1:]) <= 500 + 64 for p in got)
    finally:
        words.BLOCK = size


@pytest.mark.parametrize("seed", [1, 2])
def test_near_duplicates_equal_brute_force(spark, seed):
    texts = made(250, seed)
    sets = [frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w := words_of(t)) >= 5 else frozenset([tuple(w)]) for t in texts]
    parent = list(range(len(sets)))
    find = lambda x: x if parent[x] == x else find(parent[x])
    for a in range(len(sets)):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_duplicates(docs(spark, texts)).collect()}
    assert got == {i: (len(s), find(i)) for i, s in enumerate(sets)}
    kept = jaccard.one_of_each(docs(spark, texts))
    assert kept.columns == docs(spark, texts).columns and {r.doc_id for r in kept.collect()} == {find(i) for i in range(len(sets))}


def test_mix_meets_targets(spark):
    texts = made(400, 3, 5, 200)
    out = mixing.copies(docs(spark, texts), block=32).collect()
    again = {r.doc_id: r.taken for r in mixing.copies(docs(spark, texts).repartition(3), block=32).collect()}
    total = sum(r.size for r in out)
    for source in range(3):
        own = [r for r in out if r.doc_id % 3 == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= max(20, 0.002 * own[0].target)
        assert all(r.taken <= 2 * r.size for r in own)
    assert sum({r.doc_id % 3: r.target for r in out}.values()) == pytest.approx(1.5 * total)
    assert again == {r.doc_id: r.taken for r in out}
    assert mixing.mixed(docs(spark, texts)).columns == [c for c in docs(spark, texts).columns if c != "copy_no"] + ["copy_no"]


def test_mix_counts_words_once_without_workers_of_another_kind(spark):
    plan = mixing.mixed(docs(spark, made(60, 7)))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    assert "LogicalRDD [of#" not in plan and "LocalRelation [of#" in plan


def test_targets_stop_and_reshare():
    got = mixing.targets({"a": 10, "b": 1000, None: 100})
    assert got["a"] == 20 and sum(got.values()) == pytest.approx(1665) and got[None] <= 200


def test_flight_keeps_totals():
    import numpy as np

    draw = random.Random(5)
    size = [float(draw.randint(1, 50)) for _ in range(200)]
    p = [draw.random() for _ in size]
    order = np.argsort(-np.array(size), kind="stable")
    p, size = np.array(p)[order], np.array(size)[order]
    q = mixing.flight(p, size, np.random.default_rng(1))
    assert q.sum() == pytest.approx(p.sum()) and q @ size == pytest.approx(p @ size)
    assert ((q > 0) & (q < 1)).sum() <= 30
    r = mixing.landing(q.copy(), size, np.random.default_rng(2))
    landed = (q == 0) | (q == 1)
    assert (r[landed] == q[landed]).all() and set(r) <= {0.0, 1.0} and abs(r @ size - p @ size) <= 10


def test_flight_keeps_each_probability():
    import numpy as np

    size = np.array([3000.0, 900, 400, 300, 200, 150, 140, 130] + list(range(20, 120)) * 3, float)
    size = np.sort(size)[::-1]
    total = sum(mixing.landing(mixing.flight(np.full(len(size), 0.37), size, np.random.default_rng(k), leave=30), size, np.random.default_rng(k)) for k in range(600))
    # those large enough to be landed by flights keep theirs; the last LAND units give theirs up to the total
    assert abs(total[:100] / 600 - 0.37).max() < 0.08


def test_mix_equals_brute_force_sums(spark):
    texts = made(300, 11, 1, 120) + [None, "", "same words here"] + ["same words here"] * 4
    rows = [(i // 2 if i % 3 else i, t, None, [f"s{i % 4}", None][i % 5 == 0], 0, "x", 9, "g") for i, t in enumerate(texts)]
    d = spark.createDataFrame(rows + [(1000, "two words", None, "a", 0, "x", 9, "g")] * 7 + [(1000, "many words of the same id and so on", None, "a", 0, "y", 9, "g")] * 40, SCHEMA)
    source = {}
    for r in d.collect():
        source[r.source] = source.get(r.source, 0) + len(words_of(r.text))
    names = sorted(source, key=lambda x: (x is None, x or ""))
    weight, cap, left, want, free = {x: (5, 2, 1)[i % 3] for i, x in enumerate(names)}, {x: 2 * source[x] for x in names}, 1.5 * sum(source.values()), {}, list(names)
    while free:
        share = {x: left * weight[x] / sum(weight[y] for y in free) for x in free}
        over = [x for x in free if share[x] > cap[x]]
        if not over:
            want |= share
            break
        want |= {x: cap[x] for x in over}
        left, free = left - sum(cap[x] for x in over), [x for x in free if x not in over]
    out = mixing.copies(d).collect()
    sizes = {}
    for r in out:
        assert r.taken == r.n_copies * r.size and r.n_copies <= 2
        sizes.setdefault((r.source_size, round(r.target, 6)), []).append(r)
    assert sorted((source[x], round(want[x], 6)) for x in names) == sorted(sizes)
    assert all(abs(sum(r.taken for r in own) - target) <= 40 for (_, target), own in sizes.items())
    mix = mixing.mixed(d).collect()
    assert len(mix) == sum(r.n_copies for r in out)
    count = lambda keys: {k: keys.count(k) for k in set(keys)}
    assert count([(r.doc_id, len(words_of(r.text))) for r in mix]) == count([(r.doc_id, r.size) for r in out for _ in range(r.n_copies)])


def _base(t):
    def luhn(d):
        return sum(v - 9 * (v > 9) for v in (int(c) * (1 + i % 2) for i, c in enumerate(reversed(d)))) % 10 == 0

    out = []
    patterns = (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"))
    for k, (kind, pattern) in enumerate(patterns):
        for m in re.finditer(pattern, t):
            d = re.sub("[^0-9]", "", m[0])
            if (kind == "ip" and any(int(x) > 255 for x in m[0].split("."))) or (kind == "card" and not (12 <= len(d) <= 19 and luhn(d))) or (kind == "phone" and not 9 <= len(d) <= 15):
                continue
            out.append((m.start(), k, kind, m.end()))
    return [f"{k}:{a}:{b}" for a, _, k, b in sorted(out)]


def test_pii(spark):
    draw = random.Random(7)
    bits = ["4111 1111 1111 1111", "4111-1111-1111-1112", "a.b@c.de_f@g.hi", "1.2.3.4.5", "999.1.1.1", "+1 (743) 555-3824", "+12", "é", "😀", " x ", "call 743-555-3824", "mail me at bob at mail dot com", ".", "0001.02.3.255", "10.0.0.1", "0.00.000.0256", "+49 30 1234567-"]
    texts = ["".join(draw.choice(bits) for _ in range(draw.randint(0, 8))) for _ in range(150)] + [None, ""]
    model = pii.fit(spark)
    out = {r.doc_id: r for r in pii.report(docs(spark, texts), model).collect()}
    for i, t in enumerate(texts):
        base = _base(t or "")
        assert out[i].base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert set(base) <= set(out[i].spans.split(",")) | {""} and out[i].n_email == sum(x.startswith("email") for x in base)
    assert pii.report(odd(spark), model).count() == 13 and pii.report(odd(spark).limit(0), model).count() == 0
    clean = {r.doc_id: r.text for r in pii.redacted(docs(spark, texts), model).collect()}
    for i, t in enumerate(texts[:150]):
        want, reached = "", 0
        for kind, start, end in sorted((x.split(":") for x in out[i].spans.split(",") if x), key=lambda x: (int(x[1]), -int(x[2]), x[0])):
            start = max(int(start), reached)
            if start < int(end):
                want, reached = want + t[reached:start] + f"[{kind.upper()}]", int(end)
        assert clean[i] == want + t[reached:]
    assert clean[150] is None and pii.redacted(odd(spark), model).columns == odd(spark).columns


def test_language_id_held_out(spark):
    sample = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = langid.identify(sample).join(sample.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in out) >= 0.97 * len(out)


def test_language_id_needs_a_letter(spark):
    texts = ["— … 😀 ¿? 12", "→ ok", "the river and the town", "12 34", None, "ñ"]
    model = langid.Model(["en"], langid.np.array([0]), langid.np.full((1, langid.DIMENSIONS), langid.DIMENSIONS**-0.5, langid.np.float32), limits=langid.np.zeros((1, langid.LENGTHS)))
    got = {r.doc_id: (r.lang_pred, r.rejected) for r in langid.identify(docs(spark, texts), model).collect()}
    assert [got[i] for i in range(6)] == [("und", True), ("en", False), ("en", False), ("und", True), ("und", True), ("en", False)]
    assert {r.doc_id for r in langid.accepted(docs(spark, texts), model).collect()} == {1, 2, 5}


def test_main_text_of_mixed_names():
    body = "".join(f"<p>Paragraph {i}, with words, commas, and some more of both, as texts have.</p>" for i in range(4))
    page = f"""<div class="content with-sidebar"><div class="entry-header"><h1>Title</h1></div>{body}<div class="comment-body"><p>Nice, I, too, think so, always.</p></div>
    <div class="post-share social-text">Share</div></div><div id="sidebar-content"><p>Other, stories, here, and, there, more.</p></div>"""
    assert html.main_text(page) == "\n".join(["Title", *(f"Paragraph {i}, with words, commas, and some more of both, as texts have." for i in range(4))])


def test_main_text():
    page = """<!DOCTYPE html><html><head><title>T</title><script>if (a<b) "</p>"</script></head><body><nav><a href=x>Home</a></nav><div class="cookie-notice">We use cookies, really, all of them, always.</div>
    <header><h1>Site</h1></header><div id=main><h1>Head &amp; line</h1><p>First, a paragraph&nbsp;with <b>bold</b> text,\n and commas, many of them, here.<p>Second one, <a href=y>with a link</a>, and more words to read.</div>
    <aside>Related</aside><form><p>Subscribe now, it is free, fast, good.</p></form><div class="comments"><p>First! I, for one, like this, a lot.</p></div><footer>&copy; x</footer></body></html>"""
    assert html.main_text(page) == "Head & line\nFirst, a paragraph with bold text, and commas, many of them, here.\nSecond one, with a link, and more words to read."


def test_licenses(spark):
    draw = random.Random(8)
    bits = ["under the mit license", "Apache License, Version 2.0", "CC BY-NC 4", "licensed", "the", "GNU General Public License, version 3", "é", "mit license"]
    texts = [" ".join(draw.choice(bits) for _ in range(draw.randint(0, 9))) for _ in range(120)]
    out = {r.doc_id: r for r in licenses.scan(docs(spark, texts)).collect()}
    for i, t in enumerate(texts):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
        places = [(a, label) for label, phrase in licenses.BASE for a in range(len(w)) if w[a : a + len(phrase.split())] == phrase.split()]
        r = out[i]
        assert (r.n_words, r.n_base, r.base_labels) == (len(w), len(places), ",".join(sorted({x for _, x in places})))
        assert (r.first_word, r.last_word) == ((min(places)[0], max(places)[0]) if places else (None, None))
        assert ("gpl-3" in r.labels) == ("gnu general public license version 3" in " ".join(w))
    edited = licenses.TEMPLATES[0][1].replace("obtaining a copy", "who obtains one copy")
    assert licenses.scan(docs(spark, [edited])).first().labels == "mit"


def test_decontamination(spark):
    item = "Maria has 12 apples and gives 5 apples to Paul so how many apples does Maria keep for the rest of her week"
    benchmark = spark.createDataFrame([(0, item), (1, " ".join(PLACES)), (2, "too short")], "item_id long, text string")
    moved = "Today Sarah has 40 apples and gives 7 apples to Peter so how many apples does Sarah keep for the rest of her week ok"
    mixed_up = item.replace("Maria keep", "Peter keep").replace("Maria has", "Then Anna has")
    texts = ["Intro words. " + item + " end", moved, "nothing of the kind, only a plain text about rivers", " ".join(PLACES[:9]), "x " + " ".join(PLACES).upper() + " y", None, ""]
    got = {(r.doc_id, r.item_id): r for r in decontam.contaminated(docs(spark, texts), benchmark).collect()}
    assert set(got) == {(0, 0), (1, 0), (4, 1)} and got[1, 0].n_replaced >= 2 and got[0, 0].n_replaced == 0
    assert mixed_up != item
    assert {r.doc_id for r in decontam.clean(docs(spark, texts), benchmark).collect()} == {2, 3, 5, 6}


def test_decontamination_of_shouted_copies(spark):
    items = ["La niña añadió sólo ocho ñandúes más, él también lloró. Éramos tres. ¿Y ñu?", "Мама мыла раму и пела песню о тёплом лете у моря вчера", "İzmir'de ışık ve gölge üzerine kısa bir yazı daha okudum bugün"]
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    texts = [f"x!! {items[0].upper()}!! y", f"да, {items[1].upper()} нет", f"Dün {items[2]} sonra", "La niña añadió sólo una cosa más"]
    assert {(r.doc_id, r.item_id) for r in decontam.contaminated(docs(spark, texts), benchmark).collect()} == {(0, 0), (1, 1), (2, 2)}


def test_decontamination_of_items_full_of_numbers(spark):
    items = ["Given the numbers 3 7 12 15 18 22 27 31 find the median", "Compute 12 + 15 * 3 - 8 / 2 + 7", "Here is a list: 1 4 9 2 8 5 7 6 3 11 15 13 19 17 12 so what is its mean"]
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    texts = [f"Well. {items[0]}, please", f"so compute: {items[1]} now", f"{items[2]}?", "Given the numbers 5 6 13 14 19 20 28 40 find the median", "Here is a list: 2 5 8 3 9 6 1 7 4 12 16 14 20 18 13 so what is its mean"]
    others = ["Compute 3 + 4 * 5 - 9 / 3 + 1", " ".join(map(str, range(300))), "Given the numbers 5 6 13 14 19 20 28 40 I am glad to be here"]
    got = {(r.doc_id, r.item_id): r for r in decontam.contaminated(docs(spark, texts + others), benchmark).collect()}
    assert set(got) == {(0, 0), (1, 1), (2, 2), (3, 0), (4, 2)} and got[0, 0].n_replaced == 0 and got[3, 0].n_replaced > 0


def test_decontamination_of_names_that_open_sentences(spark):
    items = ["Tom has 12 apples. Ann gives him 5 apples. How many apples does Tom have now?", "On the way to school Maria met her friend Paul who owed Maria some pens"]
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    moved = "Jim has 40 apples. Sue gives him 7 apples. How many apples does Jim have now?"
    wrapped = "On the way to school\nSarah met her friend\nPeter who owed\nSarah some pens"
    others = [moved.replace("does Jim", "does Bob").replace("40", "7").replace("Sue gives him 7", "Sue gives him 9"), "Tom has two pears. Ann takes him a plum. How old is Tom now?", "The way to school was long. Maria met nobody there"]
    broken = "The sea was calm and blue. The sun was low in the west. The men went home"
    again = spark.createDataFrame([(0, broken)], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in decontam.contaminated(docs(spark, [moved, "x " + wrapped, *items, *others]), benchmark).collect()}
    assert set(got) >= {(0, 0), (1, 1), (2, 0), (3, 1)} and not {4, 5, 6} & {d for d, _ in got} and got[0, 0].n_replaced == 4 and got[2, 0].n_replaced == 0
    # another first word leaves the rest of a copy found
    assert len(decontam.contaminated(docs(spark, [broken.replace("The men", "All men")]), again).collect()) == 1


@pytest.mark.parametrize("size", [8, 9, 11, 13, 15, 16, 18, 20, 22, 25])
def test_decontamination_of_items_with_another_word(spark, size):
    item = PLACES[:size]
    benchmark = spark.createDataFrame([(0, " ".join(item))], "item_id long, text string")
    texts = ["so " + " ".join([*item[:i], "changed", *item[i + 1 :]]) + " it is" for i in range(size)] + ["so " + " ".join(item[: size // 2 - 1]) + " it is", " ".join(item[::-1])]
    assert {r.doc_id for r in decontam.contaminated(docs(spark, texts), benchmark).collect()} == set(range(size))


def test_decontamination_of_passages(spark):
    long = [f"{w}{i}" for i, w in enumerate(PLACES * 3)]
    sums = "Now Tom adds 12 and 15 and 3 and 8 and 2 and 7 and 19 for Ann who asks him what is left of it all on the next day when they meet in town to pay for bread and milk and more".split()
    benchmark = spark.createDataFrame([(0, " ".join(long)), (1, " ".join(sums))], "item_id long, text string")
    texts = ["x " + " ".join(long[20:45]) + " y", "x " + " ".join(long[20:33]) + " y", "x " + " ".join(long[20:32]) + " y", "so " + " ".join(sums[:13]) + " no", " ".join(long[20:32] + ["x"] + long[40:45])]
    got = {(r.doc_id, r.item_id): r.coverage for r in decontam.contaminated(docs(spark, texts), benchmark).collect()}
    assert set(got) == {(0, 0), (1, 0), (3, 1)} and max(got.values()) < 0.5


def test_decontamination_of_short_items_and_scripts_without_spaces(spark):
    items = ["What is 2+2?", "一个农夫有十二只羊，他卖掉了五只，请问他还剩下几只羊？", "ชาวนาคนหนึ่งมีแกะสิบสองตัวเขาขายไปห้าตัวเหลือกี่ตัว", "東京の人口は？"]
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    texts = ["He asked: what is 2 + 2? Nobody knew", f"题目如下。{items[1]}谢谢大家", f"โจทย์{items[2]}ครับ", f"問題、{items[3]}答え", "What is 2+3? Or 2+2", "今天的天气很好，农夫在家里休息，没有去看他的羊", None, "一个农夫有十二只羊，他卖掉了五只，请问他"]
    assert {(r.doc_id, r.item_id) for r in decontam.contaminated(docs(spark, texts), benchmark).collect()} == {(0, 0), (1, 1), (2, 2), (3, 3), (7, 1)}


def test_chat_repair_is_cheapest(spark):
    draw = random.Random(9)
    said = {c: [draw.choice(["user", "assistant", "system", "bot", None]) for _ in range(draw.randint(1, 25))] for c in range(40)}
    turns = [(c, t, r, f"m{t}") for c, rs in said.items() for t, r in enumerate(rs)]
    draw.shuffle(turns)
    out = chat.repaired(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"), block=4).collect()
    assert len(out) == len(turns)
    for c, roles in said.items():
        rows = sorted((r for r in out if r.conv_id == c), key=lambda r: r.turn)
        cost = sum(chat.RELABEL * r.action.startswith("relabel") + chat.MERGE * r.action.endswith("merge") + chat.INSERT * (r.inserted is not None) for r in rows)
        states = {0: 0.0}
        for x in map(chat.role_of, roles):
            after = {}
            for state, paid in states.items():
                for to in (1, 2, 3):
                    step = chat.RELABEL * (x not in (0, to)) + (0 if to in chat.LEGAL[state] else chat.MERGE if to == state else chat.INSERT)
                    if to in chat.LEGAL[state] or to == state or any(to in chat.LEGAL[m] for m in chat.LEGAL[state]):
                        after[to] = min(after.get(to, 1e9), paid + step)
            states = after
        end = chat.STATES.index(rows[-1].new_role)
        assert cost + chat._FINAL[end] == min(v + chat._FINAL[k] for k, v in states.items())
        tags = [t for t in re.findall(r"<\|(\w+)\|>\n", "".join(r.rendered for r in rows)) if t != "end"]
        assert tags[0] in ("system", "user") and tags[-1] == "assistant" and all(chat.STATES.index(b) in chat.LEGAL[chat.STATES.index(a)] for a, b in zip(tags, tags[1:]))


def test_fingerprints(spark):
    draw = random.Random(10)
    texts = ["".join(draw.choice("abcdé 😀\n") for _ in range(draw.randint(0, 900))) for _ in range(60)] + ["", None, "same" * 50, "same" * 50]
    out = {r.doc_id: r for r in chunks.compare_with_edits(docs(spark, texts)).collect()}
    for i, t in enumerate(texts):
        t, after = t or "", texts[(i + 1) % len(texts)] or ""
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        assert (out[i].n_chars, out[i].edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        alone = chunks.fingerprints([t.encode()])[0]
        assert out[i].fingerprint == chunks.as_text(alone) and out[i].near_next == chunks.likeness(alone, chunks.fingerprints([after.encode()])[0])
    assert out[62].near_next == 1.0
    long = "".join(draw.choice("abcdefgh ") for _ in range(20000)).encode()
    assert chunks.likeness(chunks.fingerprints([long])[0], chunks.fingerprints([b"shifted " + long])[0]) > 0.98


def test_likeness_in_blocks():
    size, chunks.BLOCK = chunks.BLOCK, 100
    text = bytes(random.Random(1).randrange(256) for _ in range(5000))
    try:
        small = chunks.fingerprints([text, text])
    finally:
        chunks.BLOCK = size
    assert [x.tolist() for x in small] == [x.tolist() for x in chunks.fingerprints([text, text])]


def test_pipeline_against_its_parts(spark):
    """Each stage of the pipeline drops or changes exactly what brute force over its own input says."""
    import corpus_pipeline

    sf_dir = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = [words_of(r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, rows, sf_dir)
        before, after = {r.doc_id: r for r in rows.collect()}, [r for r in out.collect()]
        kept = {r.doc_id for r in after}
        if name == "language_id":
            assert len(kept) >= 0.99 * len(before)
        elif name == "ngram_jaccard":
            assert kept == {r.component_id for r in jaccard.near_duplicates(rows).collect()}
        elif name == "decontamination":
            holds = lambda t: any(" ".join(i) in " ".join(words_of(t)) for i in items)
            assert {i for i, r in before.items() if holds(r.text)} <= set(before) - kept
        elif name == "pii":
            assert kept == set(before) and not any(x.split(":")[0] in ("email", "card") for r in after for x in _base(r.text))
        else:
            taken = {r.doc_id: r.n_copies for r in mixing.copies(rows).collect() if r.n_copies}
            assert {i: sum(r.doc_id == i for r in after) for i in kept} == taken
        assert out.columns[: len(rows.columns)] == rows.columns
        rows = out


def test_one_of_each_tells_rows_of_one_id_apart(spark):
    plain, other = " ".join(PLACES), " ".join(f"q{i}" for i in range(30))
    close = plain + " indeed"
    rows = [(1, plain), (1, other), (1, close), (2, plain), (2, plain), (3, other + " x"), (4, "alone here"), (4, "alone here"), (5, None), (5, ""), (5, None), (None, plain), (None, plain)]
    d = spark.createDataFrame([(i, t, None, None, None, None, None, None) for i, t in rows], SCHEMA)
    kept = sorted(((r.doc_id, r.text) for r in jaccard.one_of_each(d).collect()), key=str)
    # of plain and close, both of doc_id 1 and in one component, one stays; repeated rows are one
    assert len([x for x in kept if x[0] == 1]) == 2 and (1, other) in kept
    assert sorted((x for x in kept if x[0] != 1), key=str) == sorted([(4, "alone here"), (5, None), (5, ""), (None, plain), (None, plain)], key=str)


def test_near_duplicates_in_small_parts(spark, monkeypatch):
    texts = made(220, 5, 20, 90)
    whole = {r.doc_id: r.component_id for r in jaccard.near_duplicates(docs(spark, texts)).collect()}
    for name, value in (("PART", 3), ("QUERIES", 2), ("WIDE", 0), ("ORDERS", (0,)), ("SKETCH_BITS", 4)):
        monkeypatch.setattr(jaccard, name, value)
    assert {r.doc_id: r.component_id for r in jaccard.near_duplicates(docs(spark, texts)).collect()} == whole


#: Not made by the fitter: personal data between brackets, kind first, and look-alikes without.
SAID = """visa <card:4111.1111.1111.1111> ok|card <card:5500.0000.0000.0004>|ring <phone:555.123.4567> today|my number is <phone:020 7946 0958> at work|Tel. <phone:06 12 34 56 78> ou bien demain
Telefon <phone:030 12345678> oder|call <phone:(212) 555-0199> now|server <ip:10 . 0 . 0 . 12> is down|write to <email:bob [at] mail [dot] com>|it was <email:john (at) foo.org> who wrote|pay <card:6011-1111 1111-1117> x
<card:4111 1111 1111 1111> and <card:4242424242424242> both|Mobile <phone:0171/1234567>|Handy: <phone:0151-23456789>|llama al <phone:612 34 56 78>|llama al <phone:912 345 678>|contact <email:maria at uni-hamburg dot de> please|host <ip:192[.]168[.]1[.]77>
mail <email:a.b@example.org> first|her card is <card:5105/1051/0510/5100> I think|text me on <phone:07700 900123>, thanks|fax <phone:(089) 1234567>|ping <ip:172.16.254.1>|reach <email:kim{at}studio.io>
Born on 1990-01-15 in town|in 1990-1995 they sold 12 000 000 units|ISBN 978-3-16-148410-0 is the book|version 1. 2. 3. 4 was out|look at example.com for more|12.05.2021 14:30|pi is 3.14159265|1234.5678.9012.3456 order|the order 4111.1111.1111.1112 was sent
they stayed at home dot com is a strange name|see 10/12/2019 and 11/12/2019|it rose from 1 250 000 to 1 300 000|score 3-2 and 21-19|people at noon.They left|page 12-18 of section 4.2.1|room 404 at 7.30|paid 1.234.567 for it|built 1871-1914|serial 2020-11-05-0042"""


def test_pii_on_texts_not_made_by_the_fitter(spark):
    marked = re.split(r"[|\n]", SAID)
    texts = [re.sub(r"<\w+:([^>]*)>", r"\1", t) for t in marked]
    truth = set()
    for i, t in enumerate(marked):
        cut = 0
        for m in re.finditer(r"<(\w+):([^>]*)>", t):
            a = m.start() - cut
            truth.add((i, m[1], a, a + len(m[2])))
            cut += len(m[1]) + 3
    found = {(r.doc_id, r.kind, r.start, r.end) for r in pii.spans(docs(spark, texts)).collect()}
    for kind in pii.KINDS:
        own, got = {x for x in truth if x[1] == kind}, {x for x in found if x[1] == kind}
        assert len(own & got) >= 0.8 * len(own), (kind, own - got)
    assert len(truth & found) >= 0.95 * len(truth) and len(found - truth) <= 0.05 * len(found), (truth - found, found - truth)


def test_pii_takes_the_best_of_all_that_overlap(spark):
    d = docs(spark, ["visa 4111.1111.1111.1111 ok", "card 5500.0000.0000.0004"])
    assert [r.text for r in pii.redacted(d).orderBy("doc_id").collect()] == ["visa [CARD] ok", "card [CARD]"]


def test_main_text_keeps_short_parts_of_the_article():
    long = "".join(f"<p>Paragraph {i}, with words, commas, and some more of both, as texts have.</p>" for i in range(10))
    lines = [f"Paragraph {i}, with words, commas, and some more of both, as texts have." for i in range(10)]
    page = f"<body><div class=menu><a href=x>Home</a></div><div><h1>Title</h1><p>Short intro.</p><div class=body>{long}</div>Loose words.<p>Short end.</p><section><p>One more.</p></section><ul><li><a href=y>Other page</a></li></ul></div><footer>f</footer></body>"
    assert html.main_text(page).split("\n") == ["Title", "Short intro.", *lines, "Loose words.", "Short end.", "One more."]
    assert html.main_text(f"<div><h1>Title</h1><div><p>By line one.</p><div>{long}</div></div></div>").split("\n") == ["Title", "By line one.", *lines]
    assert html.main_text(f"<article><h2>Head</h2><div><div>{long}</div></div><p>End</p></article>").split("\n") == ["Head", *lines, "End"]
    assert html.main_text("<p>one line,<br>the same, block\n of  text</p><p>two, more, words</p>") == "one line, the same, block of text\ntwo, more, words"


def test_main_text_in_time_linear_in_the_page():
    import time

    pages = ["<div><span>" * 50_000 + "x", "</b></i></p>" * 50_000, "<a \"x <b 'y " * 50_000, '<a ">" ' * 50_000, "<" * 300_000, "<p>a<b>" * 50_000, "<ul><li>a" * 30_000, "<span>a, " * 60_000, "<div>" * 50_000 + "</span>" * 50_000]
    for page in pages:
        began = time.time()
        html.main_text(page)
        assert time.time() - began < 5, page[:20]


def test_pages_with_other_columns(spark):
    pages = spark.createDataFrame([(1, "u", "<p>a, b</p>", "t", 5, "tag")], "page_id long, url string, html string, text string, n_chars int, tag string")
    assert [tuple(r) for r in html.extract(pages).collect()] == [(1, "u", "a, b", 4)]


def test_license_labels_equal_brute_force(spark):
    draw = random.Random(12)
    long = [phrase.split() for _, phrase in licenses.TEMPLATES if len(phrase.split()) > licenses.PHRASE]
    texts = ["to use copy " * 11, "permission to use x permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"]
    for _ in range(150):
        w = []
        for _ in range(draw.randint(1, 3)):
            part = list(draw.choice(long))
            for _ in range(draw.randint(0, 4)):
                at = draw.randrange(len(part))
                part[at : at + draw.randint(0, 3)] = draw.choice([[], ["extra"], ["one", "two"], part[at : at + 2] * 2])
            w += part[draw.randint(0, 6) : len(part) - draw.randint(0, 6)] + ["so"] * draw.randint(0, 3)
        texts.append(" ".join(w))
    out = {r.doc_id: r.labels for r in licenses.scan(docs(spark, texts)).collect()}
    for i, t in enumerate(texts):
        w, labels = t.split(), set()
        for label, phrase in (*licenses.BASE, *licenses.TEMPLATES):
            want = phrase.split()
            if len(want) <= licenses.PHRASE:
                labels |= {label} if any(w[a : a + len(want)] == want for a in range(len(w))) else set()
                continue
            hits = [(p, a) for p in range(len(want) - 2) for a in range(len(w) - 2) if want[p : p + 3] == w[a : a + 3]]
            runs = []
            for d in sorted({a - p for p, a in hits}):
                if not runs or d - runs[-1][-1] > licenses.GAP:
                    runs.append([])
                runs[-1].append(d)
            for run in runs:
                n, last = 0, None
                for p, a in sorted(x for x in hits if x[1] - x[0] in run):
                    if last is None or (p > last[0] and a > last[1] and abs((a - last[1]) - (p - last[0])) <= licenses.GAP):
                        n, last = n + 1, (p, a)
                if n / (len(want) - 2) >= licenses.COVERAGE:
                    labels.add(label)
        assert out[i] == ",".join(sorted(labels)), t
    assert out[0] == "" and out[1] == "isc" and sum(bool(x) for x in out.values()) > 50


def test_chat_renders_in_order(spark):
    turns = spark.createDataFrame([(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 1, "assistant", "yes"), (1, None, None, "zero"), (2, 5, "bot", "hi"), (2, 9, "user", "q")], "conv_id long, turn long, role string, text string")
    rows = chat.in_order(chat.repaired(turns)).collect()
    got = {c: "".join(r.rendered for r in rows if r.conv_id == c) for c in (1, 2)}
    assert got[1] == "<|system|>\nzero<|end|>\n<|user|>\na\nb<|end|>\n<|assistant|>\nyes<|end|>\n"
    assert got[2] == "<|user|>\n<|end|>\n<|assistant|>\nhi<|end|>\n<|user|>\nq<|end|>\n<|assistant|>\n<|end|>\n"
    assert [(r.turn, r.part) for r in rows if r.conv_id == 1] == [(None, 1), (0, 1), (0, 2), (1, 1)]


def test_chat_of_many_blocks_and_other_columns(spark, monkeypatch):
    draw = random.Random(4)
    turns = [(c, t, draw.choice(["user", "assistant", "system", None]), "m", "x", 7) for c in range(3) for t in range(60)]
    table = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string, block string, part int")
    cost = lambda rows: sorted((c, sum(chat.RELABEL * r.action.startswith("relabel") + chat.MERGE * r.action.endswith("merge") + chat.INSERT * (r.inserted is not None) + chat.INSERT * r.rendered.endswith("<|assistant|>\n<|end|>\n") for r in rows if r.conv_id == c)) for c in range(3))
    whole = cost(chat.repaired(table).collect())
    monkeypatch.setattr(chat, "FAN", 4)
    blocks = chat.repaired(table, block=2).collect()
    # equal in cost; between repairs of equal cost the choice is made block by block
    assert len(blocks) == 180 and cost(blocks) == whole
    assert all("".join(r.rendered for r in sorted(blocks, key=lambda r: r.turn) if r.conv_id == c).count("<|end|>") > 10 for c in range(3))


def test_language_id_rejects_unseen_languages_and_noise(spark):
    sample = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    model = langid.fit(sample)
    draw = random.Random(3)
    letters, signs = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    unseen = ["Hän tuli eilen illalla kotiin ja söi lämmintä keittoa perheensä kanssa", "Wczoraj wieczorem wróciłem do domu i zjadłem ciepłą zupę z rodziną", "東京は日本の首都であり、世界でも有数の大都市である。", "Мама мыла раму и пела песню о тёплом лете у моря вчера", "Dün akşam eve geldim ve ailemle birlikte sıcak çorba içtim, sonra uyudum"]
    texts = unseen + [" ".join([t] * 30) for t in unseen]
    texts += ["".join(draw.choice(letters + " ") for _ in range(n)) for n in (200, 800, 8000)] + ["".join(draw.choice(signs) for _ in range(n)) for n in (200, 2000)]
    texts += ["for (int i = 0; i < n; i++) { if (xs[i] > max) max = xs[i]; } return max;" * 5]
    assert langid.accepted(docs(spark, texts), model).count() <= 0.1 * len(texts)
    held = langid.identify(sample.filter("text is not null"), model).filter("held_out")
    # of held-out documents of the learned languages at most one in 500 goes
    assert held.filter("rejected and lang_pred <> 'und'").count() <= held.count() / 500
    short = sample.filter("length(text) between 1 and 40")
    assert langid.accepted(short, model).count() >= 0.98 * short.count()


def test_decontamination_checks_slots_both_ways(spark):
    item = "At the fair our Maria gave some pens to our Paul and then our Anna gave some to our Oskar while our Emil took none of them home"
    benchmark = spark.createDataFrame([(0, item)], "item_id long, text string")
    swap = lambda *to: __import__("functools").reduce(lambda t, x: t.replace(*x), zip(("Maria", "Paul", "Anna", "Oskar", "Emil"), to), item)
    # all names new; two names become one, which one clash in five values allows; three become one
    texts = [swap("Sarah", "Peter", "Lena", "Jonas", "Felix"), swap("Sarah", "Peter", "Lena", "Jonas", "Peter"), swap("Sarah", "Sarah", "Sarah", "Jonas", "Felix"), item]
    got = {r.doc_id for r in decontam.contaminated(docs(spark, texts), benchmark).collect()}
    assert got == {0, 1, 3}


def test_decontamination_finds_what_brute_force_finds(spark):
    """Every document that holds all words of an item in a row, in any case, is found; no document without 8 of them is."""
    sf_dir = "/root/testdata/sf0.01"
    table, items = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    got = {(r.doc_id, r.item_id) for r in decontam.contaminated(table, items).collect()}
    split = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    said = {r.item_id: split(r.text) for r in items.collect()}
    windows = {}
    for i, w in said.items():
        for a in range(len(w) - 7):
            windows.setdefault(tuple(w[a : a + 8]), set()).add(i)
    whole, some = set(), set()
    for r in table.select("doc_id", "text").collect():
        w = split(r.text)
        near = set().union(*(windows.get(tuple(w[a : a + 8]), ()) for a in range(len(w) - 7)))
        some |= {(r.doc_id, i) for i in near}
        whole |= {(r.doc_id, i) for i in near if " ".join(said[i]) in " ".join(w)}
    assert whole and whole <= got <= some


def test_pipeline_on_odd_rows_and_an_empty_table(spark, tmp_path):
    import corpus_pipeline

    spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60).select("doc_id", "text", "lang", "source", "n_chars").unionByName(odd(spark).select("doc_id", "text", "lang", "source", "n_chars")).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(0, "a b"), (1, None)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "copy_no"] and out.count() > 0 and not out.filter("text is null").count()
    none = spark.read.parquet(str(tmp_path / "documents.parquet")).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        none = stage(spark, none, str(tmp_path))
        assert none.count() == 0
