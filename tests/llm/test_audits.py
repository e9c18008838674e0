"""Operators 11, 12 and 13: language, vector codes and divergence of sources, against plain versions."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
import regex

from martweave.llm import _text, lang_id, source_divergence, vector_codes
from martweave.llm.queries import QUERIES, shipped

# --- language ------------------------------------------------------------------

WORDS = {
    "en": "the of and to in is that with for was house street water".split(),
    "de": "der die und nicht ist ein über straße größe wasser häuser".split(),
    "fr": "le la les est une être déjà où après ÉTÉ maison rue eau".split(),
}


def written(lang, rng, n):
    return " ".join(rng.choice(WORDS[lang]) for _ in range(n))


def plain_windows(text):
    out = []
    for word in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text):
        low = re.sub("[A-ZÀ-Þ]", lambda m: chr(ord(m.group()) + 32), word)
        out.append(b" " + low.encode() + b" ")
    return Counter(w[i : i + n] for w in out for n in (2, 3, 4) for i in range(len(w) - n + 1))


def test_windows_are_those_of_each_word():
    values = ["Über die GRÖßE 1 x", "", None, "a-b  c", "日本 été", "...", "Ünd"]
    seen: dict[bytes, int] = {}
    for value in values:
        t = next(_text.texts(pa.array([value], pa.string())))
        bucket, bound = lang_id.windows(t)
        want = plain_windows(value or "")
        assert bound.tolist() == [0, len(bucket)] and len(bucket) == sum(want.values())
    # Buckets depend on the windows alone, so rows together have what they have alone.
    t = next(_text.texts(pa.array(values, pa.string())))
    bucket, bound = lang_id.windows(t)
    for i, value in enumerate(values):
        alone, _ = lang_id.windows(next(_text.texts(pa.array([value], pa.string()))))
        assert bucket[bound[i] : bound[i + 1]].tolist() == alone.tolist()
    for w in ("an", "na"):
        seen[w.encode()] = int(lang_id.windows(next(_text.texts(pa.array([w]))))[0][1])
    assert len(set(seen.values())) == 2


def test_letters():
    values = ["", None, "12 !", "a", "é", "🙂", "日", "²½", "Ⅷ", "_\n", "ª"]
    t = next(_text.texts(pa.array(values, pa.string())))
    assert lang_id.lettered(t).tolist() == [bool(regex.search(r"\p{L}", v or "")) for v in values]


def test_languages_are_told_apart(documents, spark):
    rng = random.Random(4)
    rows = [(k, written(lang, rng, rng.randint(3, 60)), lang) for k, lang in enumerate(list(WORDS) * 60)]
    odd = [(None, "the house", "en"), (900, None, "en"), (901, "12 34", "de"), (902, "le wasser", None), (5, "the of and", "en")]
    learnt = shipped(spark).createDataFrame(rows + odd, "doc_id long, text string, lang string")
    model = lang_id.train(learnt)
    assert model.languages == ("de", "en", "fr") and 0 < model.temperature and 0 <= model.threshold <= 1
    again = lang_id.train(learnt)
    assert (again.table == model.table).all()
    fresh = [written(lang, rng, 12) for lang in list(WORDS) * 20]
    df = documents(fresh + [None, "", "7 8", "🙂", "the the " * 30000], Lang_Pred=["x"] * (len(fresh) + 5), SCORE=["y"] * (len(fresh) + 5))
    found = lang_id.classify(df, model)
    assert found.columns == ["doc_id", "text", "lang_pred", "score", "accepted"]
    got = [tuple(r) for r in found.orderBy("doc_id").select("lang_pred", "score", "accepted").collect()]
    assert [g[0] for g in got[: len(fresh)]] == list(WORDS) * 20
    assert all(0 <= g[1] <= 1 for g in got)
    assert got[len(fresh) : -1] == [("und", 0.0, False)] * 4 and got[-1][0] == "en"
    # The table of buckets gives what embeddings and softmax give, text by text.
    t = next(_text.texts(pa.array(fresh[:3])))
    bucket, bound = lang_id.windows(t)
    for i in range(3):
        score = (model.table[bucket[bound[i] : bound[i + 1]]].mean(0) + model.bias) / model.temperature
        p = np.exp(score) / np.exp(score).sum()
        assert abs(p.max() - got[i][1]) < 1e-9


def test_one_language_none_and_few_rows(documents, spark):
    make = lambda rows: shipped(spark).createDataFrame(rows, "doc_id long, text string, lang string")
    one = lang_id.train(make([(1, "a b", "en"), (2, "c", "en")]))
    got = lang_id.classify(documents(["x", None]), one).orderBy("doc_id").collect()
    assert [tuple(r)[2:] for r in got] == [("en", 1.0, True), ("und", 0.0, False)]
    for rows in ([], [(1, None, "en")], [(1, "a", None)]):
        got = lang_id.classify(documents(["x"]), lang_id.train(make(rows))).collect()
        assert [tuple(r)[2:] for r in got] == [("und", 0.0, False)]
    assert lang_id.classify(documents([]), one).count() == 0
    two = lang_id.train(make([(k, "a b c", "en" if k % 2 else "de") for k in range(400)]), sample=20)
    assert two.languages == ("de", "en")


def test_calibration():
    rng = np.random.default_rng(2)
    label = rng.integers(0, 2, 4000)
    logit = np.zeros((4000, 2))
    right = rng.random(4000) < 0.8
    logit[np.arange(4000), np.where(right, label, 1 - label)] = 6.0  # far too sure
    p = lang_id._softmax(logit / lang_id._temperature(logit, label))
    assert abs(p.max(1).mean() - 0.8) < 0.03
    p = np.array([[0.9, 0.1], [0.8, 0.2], [0.7, 0.3], [0.6, 0.4]])
    assert lang_id._threshold(p, np.array([0, 0, 0, 1])) == 0.7 and lang_id._threshold(p, np.array([1, 1, 1, 1])) == 1.0


def test_held_out_languages(spark, folder):
    got = QUERIES["op11_lang_id"](spark, folder)
    assert got.columns[:4] == ["doc_id", "held_out", "lang_pred", "score"]
    truth = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    rows = got.join(truth, "doc_id").where("held_out AND lang IS NOT NULL").collect()
    assert len(rows) > 20 and sum(r["lang_pred"] == r["lang"] for r in rows) >= 0.97 * len(rows)


# --- vector codes ----------------------------------------------------------------


def plain_codes(rows, rounds=4):
    """rows: (id, vector, label) -> (id, code, error, label), components of all entries."""
    kept = [(i, v, x) for i, v, x in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    whole = [(i, [math.floor(Fraction(c) * 1024) for c in v], x) for i, v, x in kept]
    seeds = sorted(((i, v) for (i, v, _) in whole if i is not None), key=lambda s: (s[0], s[1]))[:256]
    if not seeds:
        return [(i, None, None, x) for i, _, x in whole], []
    length = len(seeds[0][1])
    seeds = sorted(((i, v) for (i, v, _) in whole if i is not None and len(v) == length), key=lambda s: (s[0], s[1]))[:256]
    width = -(-length // 4)
    cut = lambda v: [(v + [0] * (4 * width - length))[p * width : (p + 1) * width] for p in range(4)]
    books = [[cut(v)[p] for _, v in seeds] for p in range(4)]

    def near(book, part):
        far = [sum((a - b) ** 2 for a, b in zip(e, part)) for e in book]
        return far.index(min(far)), min(far)

    fitting = [cut(v) for _, v, _ in whole if len(v) == length]
    for _ in range(rounds):
        for p in range(4):
            of = defaultdict(list)
            for v in fitting:
                of[near(books[p], v[p])[0]].append(v[p])
            books[p] = [[sum(c) // len(of[e]) for c in zip(*of[e])] if e in of else entry for e, entry in enumerate(books[p])]
    out = []
    for i, v, x in whole:
        found = [near(books[p], part) for p, part in enumerate(cut(v))] if len(v) == length else None
        error = sum(f[1] for f in found) if found else None
        out.append((i, "".join(f"{f[0]:02x}" for f in found) if found else None, error if error is None or error < 2**63 else None, x))
    return out, [c for book in books for entry in book for c in entry]


@pytest.mark.parametrize("scale", [1.0, 1e6, 1e30])
def test_codes_equal_a_plain_version(spark, scale):
    rng = np.random.default_rng(7)
    rows = [(int(i), (rng.normal(size=8).round(2) * scale).tolist(), None if i % 5 == 0 else int(i % 3)) for i in rng.permutation(300)]
    rows += [(3, None, 1), (4, [1.0, None] + [0.0] * 6, 1), (5, [float("nan")] * 8, 1), (6, [float("inf")] * 8, 1)]
    rows += [rows[0], rows[1], (rows[2][0], [0.5] * 8, 2), (None, [0.25] * 8, 2), (7, [1.0, 2.0], 7), (8, [], 7)]
    df = shipped(spark).createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("CODES", df_lit("x"))
    want, books = plain_codes(rows)
    got = vector_codes.digests(df.repartition(3)).collect()
    sums, unknown = defaultdict(int), set()
    for _, code, error, label in want:
        sums[label] += error or 0
        if code and error is None:
            unknown.add(label)
    full = [(i, c, e, None if x in unknown or sums[x] >= 2**63 else sums[x]) for i, c, e, x in want]
    assert sorted(map(repr, full)) == sorted(repr(tuple(r)[:4]) for r in got)
    assert {r[4] for r in got} == {hashlib.sha256(",".join(map(str, books)).encode()).hexdigest()}
    kept = vector_codes.assign(df, *vector_codes.fit(df))
    assert kept.columns == ["vec_id", "embedding", "label", "codes", "error"]


def df_lit(value):
    from pyspark.sql import functions as F

    return F.lit(value)


def test_odd_lengths_few_vectors_and_none(spark):
    make = lambda rows: shipped(spark).createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    rows = [(k, [0.1 * k, -1.0, 2.5, 3.0, 0.0, 1.0], 0) for k in range(9)]
    want, _ = plain_codes([(i, np.float32(v).astype(float).tolist(), x) for i, v, x in rows])
    got = vector_codes.digests(make(rows)).collect()
    assert sorted((r[0], r[1], r[2]) for r in got) == sorted(w[:3] for w in want)
    assert vector_codes.digests(make([])).collect() == []
    nameless = vector_codes.digests(make([(None, [1.0] * 4, 1)])).collect()
    assert [tuple(r)[:4] for r in nameless] == [(None, None, None, 0)]


def test_limbs_add_up():
    values = [0, 1, -1, 2**31, -(2**31) - 5, 10**30, -(10**40)]
    back = [0] * len(values)
    for slot, limb, value in vector_codes._limbs(np.array(values, object)):
        back[slot] += value << (32 * limb)
    assert back == values


# --- divergence of sources ----------------------------------------------------------


def plain_audit(rows, least, top):
    term = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    low = lambda s: re.sub("[A-Z]", lambda m: m.group().lower(), s)
    count, held, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        found = term.findall(low(text or ""))
        count[lang, source].update(found)
        held[lang].update(set(found))
    out = []
    for lang, sources in groups.items():
        kept = sorted(t for t, n in held[lang].items() if n >= least)
        number = {s: {t: count[lang, s][t] for t in kept} for s in sources}
        number[None] = {t: sum(number[s][t] for s in sources) for t in kept}
        share = {
            s: {t: 1 + 10**9 * (n + 2) // (sum(c.values()) + 2 * len(kept)) for t, n in c.items()} for s, c in number.items()
        }
        f = lambda p, q: (p - q) ** 2 // (p + q)
        for s in sources:
            pair = [(-sum(f(share[s][t], share[o][t]) for t in kept), o.encode(), o) for o in sources if o != s]
            best = [(-f(share[s][t], share[None][t]), t.encode(), t) for t in kept if number[s][t] and share[s][t] > share[None][t]]
            for part, items, most in (("pair", pair, len(pair)), ("term", best, top)):
                out += [(lang, s, part, name, -value, k) for k, (value, _, name) in enumerate(sorted(items)[:most], 1)]
    return sorted(out)


def corpus(n, seed=3):
    rng = random.Random(seed)
    words = ["The", "of", "été", "Zug", "x", "日本", "water", "wörd", "a1b", "éa"] + [f"w{'abcdefgh'[k % 8]}{'ijklm'[k % 5]}" for k in range(40)]
    rows = []
    for k in range(n):
        text = " ".join(rng.choice(words[: rng.choice([4, 20, 50])]) for _ in range(rng.choice([0, 1, 8, 60])))
        rows.append((text, rng.choice(["en", "de"]), "hot" if k % 3 == 0 else f"s{rng.randint(0, 6)}"))
    rows += [(None, "en", "empty"), ("", "en", "é"), ("12 34", None, None), ("the the", None, "s1"), ("the", "fr", "only")]
    return rows + rows[:5]


@pytest.mark.parametrize("blocks", [(32, 16384), (2, 3), (1, 1)])
def test_divergence_equals_a_plain_version(spark, blocks):
    rows = corpus(120)
    made = shipped(spark).createDataFrame([(1, *r, "x", 5) for r in rows], "doc_id long, text string, lang string, source string, Term string, n int")
    got = source_divergence.audit(made.repartition(4), least=5, top=3, group_block=blocks[0], term_block=blocks[1])
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == plain_audit(rows, 5, 3)


def test_slices_and_batches_add_up(spark):
    rows = corpus(60, 5)
    made = shipped(spark).createDataFrame(rows, "text string, lang string, source string").coalesce(1)
    whole = source_divergence.term_counts(made)
    held = {}
    for r in whole.collect():
        key = (r["lang"], r["source"], r["term"])
        held[key] = tuple(a + b for a, b in zip(held.get(key, (0, 0)), (r["n"], r["docs"])))
    want = defaultdict(lambda: [0, 0])
    for text, lang, source in rows:
        found = Counter(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or "")))
        for term, n in found.items():
            want[lang or "", source or "", term][0] += n
            want[lang or "", source or "", term][1] += 1
    assert held == {k: tuple(v) for k, v in want.items()}


def test_no_terms_and_no_documents(spark):
    make = lambda rows: shipped(spark).createDataFrame(rows, "text string, lang string, source string")
    assert source_divergence.audit(make([])).collect() == []
    got = source_divergence.audit(make([("a b", "en", "s1"), (None, "en", "s2")])).collect()
    assert sorted(map(tuple, got)) == [("en", "s1", "pair", "s2", 0, 1), ("en", "s2", "pair", "s1", 0, 1)]


def test_shares_beyond_64_bits():
    count, total = np.array([[9 * 10**15, 0]]), np.array([10**16])
    assert source_divergence._shares(count, total).tolist() == [[1 + (9 * 10**15 + 2) * 10**9 // 10**16, 1]]


@pytest.mark.parametrize("name", ["op10_line_quality", "op11_lang_id"])
def test_rows_without_an_id_are_scored_and_neither_held_out_nor_learnt_from(spark, tmp_path, name):
    rows = [(k, f"{written('en' if k % 2 else 'de', random.Random(k), 9)}.", "en" if k % 2 else "de", "s", 1) for k in range(30)]
    rows += [(None, "the house", "xx", "s", 1), (None, None, None, None, None)]
    made = shipped(spark).createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    made.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(k, k % 2, 0) for k in range(30)] + [(None, 0, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").coalesce(1).write.parquet(f"{tmp_path}/labels.parquet")
    got = QUERIES[name](spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    assert [r["held_out"] for r in got if r["doc_id"] is None] == [None, None]
    assert all(0 <= r["score"] <= 1 for r in got)
    if name == "op11_lang_id":
        assert {r["lang_pred"] for r in got} == {"en", "de", "und"}
