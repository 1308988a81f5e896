"""WARC (2), chat (3), language (4), decontamination (6), Order MinHash (9), mixing (10)."""

from __future__ import annotations

import gzip
import hashlib
import json
import math
import random
import re
import unicodedata
from collections import Counter
from fractions import Fraction

import pytest
from helpers import awkward, empty, key, texts_of, words
from pyspark.sql import functions as F

from jobloom.llm import chat, decontaminate, language, mixing, orderhash, warc
from jobloom.session import shared_dir

# --- WARC ------------------------------------------------------------------------


def pages(spark, *rows):
    return spark.createDataFrame([(i, u, h, "x") for i, u, h in rows], "page_id long, url string, html string, archive string")


def test_archives_round_trip(spark):
    twin, big = "<p>ü " + "x" * 200, "<b>\r\n\r\nWARC/1.1\r\n" * 40_000
    given = pages(
        spark, (3, "http://a/%\r\nX: y", twin), (1, None, twin), (2, "u", twin), (4, "u", "short"), (5, "u", "short"), (6, "u", None),
        (7, "u", big), (None, "u", twin), (8, "u", "solo" * 50), (8, "u", "solo" * 50),
    )
    raw, folder = warc.archive_pages(given, records_per_archive=3)
    index = warc.read_sidecars(spark, folder)
    got = warc.read_records(index, payloads=True).collect()
    by_id = {}
    for r in got:
        by_id.setdefault(r.record_id, []).append(r)
    name = lambda i: f"<urn:page:{i}>"
    assert {k: len(v) for k, v in by_id.items()} == {name(i): 2 if i == 8 else 1 for i in (1, 2, 3, 4, 5, 6, 7, 8, "null")}
    for i in (2, 3, "null"):
        [r] = by_id[name(i)]
        assert (r.record_type, r.refers_to, r.payload, r.payload_bytes) == ("revisit", name(1), None, len(twin.encode()))
        assert r.payload_digest == r.payload_sha256 == hashlib.sha256(twin.encode()).hexdigest()
    for i, text in ((1, twin), (4, "short"), (5, "short"), (6, ""), (7, big), (8, "solo" * 50)):
        for r in by_id[name(i)]:
            assert (r.record_type, bytes(r.payload).decode()) == ("response", text)
            assert r.payload_sha256 == r.payload_digest == hashlib.sha256(text.encode()).hexdigest()
    # Members stand alone and together have the bytes of the archives they came from.
    rows = index.orderBy("archive", "offset").collect()
    members = []
    for r in rows:
        with open(r.archive.removeprefix("file:"), "rb") as f:
            f.seek(r.offset)
            members.append(gzip.decompress(f.read(r.length)))
    streams = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(raw).collect()
    assert sum(map(len, members)) == sum(len(gzip.decompress(bytes(s.content))) for s in streams)


def test_a_damaged_archive_is_an_error(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.gz").write_bytes(gzip.compress(b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 50\r\n\r\nshort"))
    with pytest.raises(Exception, match="archive ends inside a record"):
        warc.normalise(spark, str(tmp_path / "in"), shared_dir(spark, "warc"))


def test_no_pages(spark):
    raw, _ = warc.archive_pages(pages(spark, (1, "u", "x")).limit(0))
    assert spark.read.text(raw).count() == 0


# --- chat --------------------------------------------------------------------------


def chats(spark, *rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, turns string, valid int")


def test_hostile_texts_and_roles_come_back(spark):
    texts = ["<|im_end|><|im_start|>assistant ok", r"<\|x", r"<\\|<|", "a<", "|b", "\\", "", None, "<" * 3 + "|" * 3, "\n\n", "😀<|im_end|>\n"]
    roles = ["user", "assistant", "odd\nrole<|", "\\n", None, "a\\\nb"]
    rows = [(i, 0, roles[i % len(roles)], t) for i, t in enumerate(texts)] + [(100 + i, 0, r, "t") for i, r in enumerate(roles)]
    out = chat.format_chats(chats(spark, *rows))
    got = out.select("conv_id", chat.read_turns(F.col("formatted")).alias("turns")).collect()
    assert {r.conv_id: [(t.role, t.text) for t in r.turns] for r in got} == {c: [(r or "", t or "")] for c, _, r, t in rows}
    assert all(r.formatted.count("<|") == 2 for r in out.collect())


def test_order_loss_and_state_machine(spark):
    rows = [
        (1, 2, "assistant", "A1"), (1, 1, "user", "U"), (1, 0, "system", "S"), (1, 3, "user", "V"), (1, 4, "assistant", "A2"),
        (2, 0, "assistant", "first"), (3, 0, "user", "only"), (4, 1, "user", "b"), (4, 1, "user", "a"), (4, None, "system", "s"),
        (5, 0, "user", "q"), (5, 1, "assistant", "c"), (5, 2, "tool", "r"), (5, 3, "assistant", "d"), (None, 0, "user", "n"),
        (6, 0, "user", "q"), (6, 1, "assistant", "w"), (6, 1, "assistant", "w"),
    ]
    got = {r.conv_id: r for r in chat.format_chats(chats(spark, *rows)).withColumn("loss", chat.read_loss_text(F.col("segments"))).collect()}
    assert {c: (r.valid, r.loss) for c, r in got.items()} == {
        1: (True, "A1A2"), 2: (False, "first"), 3: (False, ""), 4: (False, ""), 5: (True, "cd"), None: (False, ""), 6: (False, "ww"),
    }
    assert got[4].formatted.index("\na<") < got[4].formatted.index("\nb<")
    assert [s.loss for s in got[3].segments] == [False] * 3
    assert chat.format_chats(chats(spark).limit(0)).count() == 0
    with pytest.raises(ValueError):
        chat.ChatTemplate(open_mark="[INST]")


# --- language ----------------------------------------------------------------------

FUNCTION = {"aa": "the of and to in is that for".split(), "bb": "der die und das ist nicht mit von".split()}
STEMS = {"aa": ["wood", "river", "think"], "bb": ["schl", "brück", "größ"]}


def said(lang, seed, n=60):
    r = random.Random(seed)
    return " ".join(r.choice(FUNCTION[lang]) if r.random() < 0.5 else r.choice(STEMS[lang]) + r.choice(["en", "s", "er", "ung"]) for _ in range(n))


def test_words_then_ngrams_decide(spark):
    rows = [(i, said(lang, i), lang) for i in range(60) for lang in ("aa", "bb")] + [(900, None, "aa"), (901, "x", None)]
    model = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.languages == ["aa", "bb"]
    asked = [(1, said("aa", 999)), (2, said("bb", 998)), (3, "woodrivering thinks"), (4, "brückschlung größungen"), (5, None), (6, ""), (7, "12 ... 3"), (8, "the"), (8, "the"), (9, "漢字"), (10, "the " * 50_000)]
    docs = spark.createDataFrame([(*a, "x", 0.5) for a in asked], "doc_id long, text string, lang_pred string, score double")
    got = sorted((r.row.doc_id, r.lang_pred, r.score) for r in language.identify(docs, model).collect())
    assert [(d, p) for d, p, _ in got] == [
        (1, "aa"), (2, "bb"), (3, "aa"), (4, "bb"), (5, "und"), (6, "und"), (7, "und"), (8, "aa"), (8, "aa"), (9, "aa"), (10, "aa"),
    ]
    assert all(0 <= s <= 1 for *_, s in got)
    assert language.identify(docs.limit(0), model).count() == 0
    kept = language.identify(docs, model, keep=["doc_id", "lang_pred"])
    assert kept.select("row.doc_id", "lang_pred").count() == len(asked)


def plain_words(text):
    runs = "".join(c if unicodedata.category(c)[0] in "LM" else " " for c in text.lower()).split()
    return [w for w in runs if any(unicodedata.category(c)[0] == "L" for c in w)]


def plain_model(rows, longest=5, smoothing=0.5):
    languages = sorted({lang for _, _, lang in rows})
    words, grams = ({k: Counter() for k in languages} for _ in range(2))
    for _, text, lang in rows:
        for w in plain_words(text):
            words[lang][w] += 1
            padded = f" {w} "
            grams[lang].update(padded[i : i + n] for n in range(1, longest + 1) for i in range(len(padded) - n + 1))

    def logs(tables, totals):
        keys = {k for t in tables for k in t}
        return {k: tuple(math.log(t[k] + smoothing) - math.log(n + smoothing * (len(keys) + 1)) for t, n in zip(tables, totals, strict=True)) for k in keys}

    often = [Counter({w: n for w, n in words[k].items() if n >= 2 and len(w) <= 40}) for k in languages]
    by_size = {n: [Counter({g: c for g, c in grams[k].items() if len(g) == n}) for k in languages] for n in range(1, longest + 1)}
    return languages, logs(often, [words[k].total() for k in languages]), {n: logs(t, [x.total() for x in t]) for n, t in by_size.items()}


def test_fit_and_prediction_equal_plain_recomputation(spark):
    long = "".join(random.Random(1).choice("abcdeßü") for _ in range(2345))
    odd = [(70, f"{long} x", "aa"), (71, "e\u0301te\u0301 \u0301\u0301 ½ été", "bb"), (72, "हिन्दी हिन्दी", "bb"), (73, "a" * 41 + " " + "a" * 41, "aa"), (74, "x² 3rd", "aa")]
    rows = [(i, said(lang, i, 20), lang) for i in range(12) for lang in ("aa", "bb")] + odd
    model = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    languages, words, grams = plain_model(rows)
    near = lambda a, b: a.keys() == b.keys() and all(x == pytest.approx(y) for k in a for x, y in zip(a[k], b[k], strict=True))
    assert model.languages == languages and near(model.words, words)
    assert all(near(model.grams[n], grams[n]) for n in grams)
    scorer = language.Scorer(model)
    for text in ["½ ²", "12 ⅷ́", "\u0301", "", None, "१२"]:
        assert scorer.predict(text) == ("und", 0.0)
    for text in ["ete\u0301 e\u0301te\u0301", "हिन्दी", "the woodrivering", f"{long[:400]}q", "brückschlung und"]:
        found = Counter(plain_words(text))
        totals = [sum(n * language.word_score(w, model)[i] for w, n in found.items()) for i in range(2)]
        best = max(range(2), key=lambda i: (totals[i], -i))
        share = 1 / sum(math.exp((t - totals[best]) / found.total()) for t in totals)
        assert scorer.predict(text) == (languages[best], pytest.approx(share))
    assert scorer.scores.keys() >= {"e\u0301te\u0301"} or "e\u0301te\u0301" in model.words


def test_backoff_takes_the_longest_known_piece():
    model = language.Model(["a", "b"], [0, 0], {"known": (-1.0, -9.0)}, {1: {x: (-4.0, -4.0) for x in " ab"}, 2: {"ab": (-5.0, -1.0)}}, (-7.0, -7.0), 2)
    assert language.word_score("known", model) == (-1.0, -9.0)
    assert language.word_score("aba", model) == (-4.0 - 5.0 - 4.0 - 4.0, -4.0 - 1.0 - 4.0 - 4.0)
    assert language.word_score("z", model) == (-4.0 - 7.0 - 4.0,) * 2


def test_nothing_to_learn_from(spark):
    model = language.fit(empty(spark))
    assert [(r.lang_pred, r.score) for r in language.identify(spark.createDataFrame([("a b",)], "text string"), model).collect()] == [("und", 0.0)]


# --- decontamination ------------------------------------------------------------------


def plain_hits(docs, items, size=10):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    windows = {}
    for i, t in items:
        w = cut(t)
        for s in range(max(1, len(w) - size + 1)) if w else []:
            windows.setdefault(tuple(w[s : s + size]), set()).add("null" if i is None else str(i))
    out = []
    for d, t in docs:
        w, hit, found = cut(t), set(), set()
        for n in {len(x) for x in windows}:
            for s in range(len(w) - n + 1):
                if (got := windows.get(tuple(w[s : s + n]))) is not None:
                    hit |= set(range(s, s + n))
                    found |= got
        out.append((d, len(w), len(hit), sorted(found)))
    return sorted(out, key=key)


@pytest.mark.parametrize("block", [1000, 7])
def test_items_are_found_as_by_brute_force(spark, block):
    a, b = words(500, 30), words(501, 14)
    items = [(1, a), (2, b), (3, "tiny item"), (4, "the"), (5, None), (6, " .. "), (7, a), (None, words(502, 12)), (8, "no one says this at all in any of them"), (9, "x x x x x x x x x x x x")]
    docs = awkward(
        spark,
        (100, f"start {a.upper()} end"), (101, " ".join(a.split()[4:18])), (102, " ".join(a.split()[4:13])), (103, f"TINY, Item! {b} the"),
        (104, "x " * 40), (105, words(502, 12) + " ÉÜ " + words(502, 12)), (106, " ".join(b.split()[:9]) + " gap " + " ".join(b.split()[9:])),
    )
    asked = spark.createDataFrame([(i, t, "z") for i, t in items], "item_id long, text string, words string")
    got = decontaminate.find_items(docs, asked, block_windows=block)
    assert sorted(((r.doc_id, r.n_words, r["n_hit"], r["items"]) for r in got.collect()), key=key) == plain_hits(texts_of(docs), items)


def test_no_items_or_no_documents(spark):
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert decontaminate.find_items(empty(spark), items).count() == 0
    got = decontaminate.find_items(awkward(spark), items.limit(0)).collect()
    assert len(got) == 15 and not any(r["n_hit"] for r in got)


# --- Order MinHash ----------------------------------------------------------------------


def signatures(spark, *texts, filled=False):
    df = orderhash.with_signature(spark.createDataFrame(list(enumerate(texts)), "n int, text string"), "text", "s", filled=filled)
    return [r.s for r in df.orderBy("n").collect()]


def alike(a, b):
    either = [(x, y) for x, y in zip(a, b) if x is not None or y is not None]
    return sum(x == y for x, y in either) / len(either) if either else 1.0


def test_signatures_follow_edits_and_order(spark):
    base = words(9, 400).split()
    swapped = base[200:] + base[:200]
    few = base[:50] + ["new"] + base[51:]
    s = signatures(spark, " ".join(base), " ".join(base), " ".join(few), " ".join(swapped), words(10, 400), "", None, "one", "one two", "ab" * 900, " ".join(base * 2))
    assert s[0] == s[1] and s[6] is None and s[5] == [None] * orderhash.CELLS
    assert alike(s[0], s[2]) > 0.9 > 0.75 > alike(s[0], s[3]) > alike(s[0], s[4])
    assert sum(x is not None for x in s[7]) == 1 and s[7] != s[8]
    assert s[10] != s[0]  # occurrences are numbered


@pytest.mark.parametrize("filled", [False, True])
@pytest.mark.parametrize(("n_words", "kinds"), [(300, 4), (9, 9), (2, 1)])
def test_signature_equals_a_plain_one(spark, filled, n_words, kinds):
    """Cells hold the hash of their least numbered k-mers in text order, by a plain computation on Spark's own hash."""
    text = " ".join(random.Random(n_words).choice(["a", "b", "cc", "ddd", *(f"w{i}" for i in range(26))][:kinds]) for _ in range(n_words))
    hashed = lambda *v: spark.range(1).select(F.xxhash64(*[F.lit(x) for x in v])).first()[0]
    said_ = text.split()
    seen, pairs, memo = {}, [], {}
    for i in range(len(said_) - 1):
        gram = tuple(said_[i : i + 2])
        if gram not in memo:
            memo[gram] = (hashed(*gram) % 2**64) >> 31
        seen[gram] = seen.get(gram, 0) + 1
        pairs.append((memo[gram], seen[gram] - 1, i))
    values = spark.createDataFrame(pairs, "h long, n int, i int").select(F.xxhash64("h", "n"), "i").collect()
    numbered = sorted(((v % 2**64) >> 31, i) for v, i in values)
    chosen = []
    for c in range(orderhash.CELLS):
        at = [p for p, x in enumerate(numbered) if x[0] >> 27 == c]
        if filled and at:  # what follows in hash order, going round
            at = [(at[0] + d) % len(numbered) for d in range(min(2, len(numbered)))]
        chosen.append([g for _, g in sorted((numbered[p][1], numbered[p][0]) for p in at[:2])])
    hashes = spark.createDataFrame(list(enumerate(chosen)), "c int, g array<long>").select("c", F.xxhash64("g").alias("h")).collect()
    of_cell = {r.c: r.h & 0xFFFF for r in hashes}
    assert signatures(spark, text, filled=filled)[0] == [of_cell[c] if g else None for c, g in enumerate(chosen)]


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_next_document_is_the_one_below(spark, parts):
    docs = awkward(spark, *[(1000 + 7 * i, words(700 + i, 12)) for i in range(25)]).where("doc_id is null or doc_id not in (7, 8)")
    docs = docs.where("doc_id is not null or text is not null")
    got = orderhash.fingerprint_edits(docs, parts=parts).collect()
    order = sorted(((d, t or "") for d, t in texts_of(docs)), key=lambda x: (x[0] is None, -(x[0] or 0)))
    want = {}
    for i, (d, t) in enumerate(order):
        after, half = order[(i + 1) % len(order)][1], len(t) // 2
        want[d] = t[: len(t) - half] + after[:half]
    assert {r.doc_id: r.edited for r in got} == want and len(got) == len(want)
    by_id = {r.doc_id: r for r in got}
    for i, (d, _) in enumerate(order):
        assert by_id[d].near_next == pytest.approx(alike(by_id[d].signature, by_id[order[(i + 1) % len(order)][0]].signature))
        assert by_id[d].near_edited == pytest.approx(alike(by_id[d].signature, by_id[d].edited_signature))


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_one_id_and_one_text_may_hold_most_rows(spark, parts):
    """Null ids, an id with many texts, and thousands of equal rows: the chain of next rows equals a plain sort's."""
    rows = [(i, words(i, 5)) for i in range(60)] + [(None, words(900 + i, 4)) for i in range(50)] + [(30, words(2000 + i, 4)) for i in range(70)]
    rows += [(31, "said again and again")] * 2300 + [(None, None)] * 90 + [(30, "")] * 40
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    hashed = {(r.doc_id, r.text): r.tie for r in docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("tie")).distinct().collect()}
    order = sorted(((d, t or "") for d, t in rows), key=lambda x: (x[0] is None, -(x[0] or 0), -hashed[x]))
    want = []
    for i, (d, t) in enumerate(order):
        after, half = order[(i + 1) % len(order)][1], len(t) // 2
        want.append((d, t, t[: len(t) - half] + after[:half]))
    got = orderhash.fingerprint_edits(docs, parts=parts)
    assert sorted(((r.doc_id, r.text, r.edited) for r in got.collect()), key=key) == sorted(want, key=key)


def test_no_documents_and_one(spark):
    assert orderhash.fingerprint_edits(empty(spark), parts=3).count() == 0
    [r] = orderhash.fingerprint_edits(awkward(spark).where("doc_id = 1"), parts=2).collect()
    assert r.near_next == 1.0
    assert orderhash.fingerprint_edits(awkward(spark), parts=2).count() == 15


# --- mixing ---------------------------------------------------------------------------------


def plain_water_fill(sizes, weights, total, cap):
    """Share by weight; what a share has above its cap is shared again among those still below theirs."""
    shares = [Fraction(0)] * len(sizes)
    open_, left = [i for i, s in enumerate(sizes) if s > 0], Fraction(total)
    while open_:
        unit = left / sum(weights[i] for i in open_)
        full = [i for i in open_ if weights[i] * unit > cap * sizes[i]]
        for i in full or open_:
            shares[i] = cap * sizes[i] if full else weights[i] * unit
        left -= sum(shares[i] for i in full)
        open_ = [i for i in open_ if full and i not in full]
    return shares


@pytest.mark.parametrize("seed", range(5))
def test_water_level_equals_filling_one_by_one(spark, seed):
    r = random.Random(seed)
    sizes = [r.choice([0, 1, 10, 1000, 10**9]) * r.randint(1, 9) for _ in range(r.randint(1, 40))]
    weights = [(3, 1, 2)[i % 3] for i in range(len(sizes))]
    share, cap = r.choice([(Fraction(3, 2), Fraction(2)), (Fraction(5), Fraction(7, 3)), (Fraction(1, 7), Fraction(1))])
    names = [f"{i:03}" for i in range(len(sizes))]
    given = mixing._weighed(spark.createDataFrame(list(zip(names, sizes)), "m_source string, n long").repartition(3), (3, 1, 2))
    level = mixing.water_level(given, share, cap)
    got = {r.m_source: r for r in mixing._allotted(given, level, cap).collect()}
    for name, n, target in zip(names, sizes, plain_water_fill(sizes, weights, share * sum(sizes), cap)):
        words_ = min(round(target), int(cap * n))
        whole, rest = divmod(words_, n) if n else (0, 0)
        assert tuple(got[name])[1:] == (n, float(target), whole, rest)


def test_caps_below_the_total_are_all_met(spark):
    given = spark.createDataFrame([("a", 10, 1), ("b", 0, 1), ("c", 5, 1)], "m_source string, n long, m_weight long")
    assert mixing.water_level(given, Fraction(100, 15), Fraction(2)) is None
    assert sorted((r.m_source, r.m_target) for r in mixing._allotted(given, None, Fraction(2)).collect()) == [("a", 20), ("b", 0), ("c", 10)]


@pytest.mark.parametrize("most_broadcast", [16 << 20, 0])
def test_documents_taken_equal_plain_recomputation(spark, most_broadcast):
    """Sizes, targets and taken words of every row; only the seeded hash comes from Spark."""
    docs = awkward(spark, *[(500 + i, words(800 + i, 5 + i % 40)) for i in range(80)], *[(700, words(77, 9))] * 3)
    docs = docs.withColumn("source", F.when(F.col("doc_id") >= 540, F.concat(F.lit("many "), F.col("doc_id").cast("string"))).otherwise(F.col("source")))
    run = lambda: sorted(((r.row.doc_id, r.row.text, r.row.source, r.size, r.source_size, r.target, r.whole, r.part, r.taken) for r in mixing.mix(docs, most_broadcast=most_broadcast).collect()), key=key)
    rows = docs.select("doc_id", "text", "source", F.xxhash64(F.lit(42), F.col("doc_id").cast("string"), "text").alias("h")).collect()
    size = {r.text: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in rows}
    by_source = {}
    for r in rows:
        by_source.setdefault(r.source, []).append(r)
    names = sorted(by_source, key=lambda s: (s is None, s or ""))
    sizes = [sum(size[r.text] for r in by_source[s]) for s in names]
    targets = plain_water_fill(sizes, [(3, 1, 2)[i % 3] for i in range(len(names))], Fraction(3, 2) * sum(sizes), Fraction(2))
    want = []
    for name, n, target in zip(names, sizes, targets):
        whole, rest = divmod(min(round(target), 2 * n), n) if n else (0, 0)
        at = {}
        for r in by_source[name]:
            at.setdefault((r.h % 2**64) >> 1, []).append(r)
        for place in sorted(at):
            here = sum(size[r.text] for r in at[place])
            given, rest = (here, rest - here) if here <= rest else (rest, 0)
            for r in at[place]:
                part = size[r.text] if given == here else given // len(at[place])
                want.append((r.doc_id, r.text, r.source, size[r.text], n, float(target), whole, part, whole * size[r.text] + part))
    got = run()
    assert got == sorted(want, key=key) and got == run()


def test_repeated_rows_share_the_cut_and_texts_are_cut(spark):
    docs = spark.createDataFrame([(1, "a b c d", "s", 7)] * 3 + [(2, "e f g h", "t", 7)], "doc_id long, text string, source string, n_chars int")
    mixed = mixing.mix(docs)
    out = mixing.repeated(mixed, docs.columns, length_col="n_chars")
    assert out.schema == docs.schema or [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
    said_ = [len(r.text.split()) for r in out.collect()]
    assert sum(said_) == mixed.agg(F.sum("taken")).first()[0]
    assert all(r.n_chars == len(r.text) for r in out.collect())


@pytest.mark.parametrize("most_broadcast", [16 << 20, 0])
def test_no_sources(spark, most_broadcast):
    assert mixing.mix(empty(spark), most_broadcast=most_broadcast).count() == 0


def test_queries_and_sql_names():
    import __spark_entry__ as driver

    from jobloom.llm.queries import ORACLE, QUERIES

    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert driver.queries().keys() >= {*QUERIES, "pipeline"} and driver.oracle_sql().keys() >= ORACLE.keys()
    assert json.dumps(sorted(ORACLE))
