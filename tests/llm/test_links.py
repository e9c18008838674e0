"""Operators 1, 2 and 4: SQL or brute force on small fixtures."""

from __future__ import annotations

import math
import random
import textwrap
from fractions import Fraction
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from martweave.llm import licenses, mtree, queries, quotations
from martweave.llm.license_texts import LICENSES

CONVERSATIONS = [
    (1, 0, "user", "First question about the blue engine.\nIt makes a loud noise."),
    (1, 1, "assistant", "On Monday A wrote:\n> First question about the blue engine.\n> It makes a loud noise.\nCheck the oil level first."),
    (1, 2, "user", "> > It makes a loud noise.\n> check the OIL level first\n\nDone, still loud."),
    (1, 3, "user", ">> It makes a loud noise.\nAny more ideas here?"),
    (1, 3, "user", "> Done, still loud.\nA second message of that turn."),
    (2, 0, "user", "> Check the oil level first.\nQuoted from elsewhere."),
    (2, 1, "user", "> nobody ever said this\n>\n> > "),
    (2, 2, "user", None),
    (2, 3, "user", ""),
    (2, 4, "user", "> Quoted from elsewhere.\n> > Done, still loud.\nok\n> Quoted from elsewhere.\nok"),
    (None, 5, "user", "> Quoted from elsewhere.\nlost"),
    (3, None, "user", "Check the oil level first."),
    (3, 1, None, "ok"),
    (3, 2, "user", "> ok\nok"),
    (4, 0, "user", "On reflection, as Smith wrote:\nall engines are loud engines.\nOn Monday A wrote:\n\n\n> Done, still loud.\nOn Tuesday B wrote:"),
    (4, 1, "user", "> On reflection, as Smith wrote:\n> all engines are loud engines.\n> On Sunday C wrote:\n>\n> > nothing like that\nyes"),
    (4, 2, "user", "Le jour X a écrit:\n>\nno quote behind this\nOn and on wrote:\n" + "\n" * 60 + "> yes"),
]


def talk(spark, rows):
    return queries.shipped(spark).createDataFrame(rows, "conv_id long, turn long, role string, text string")


def same_as_sql(spark, df, sql, **tables):
    con = duckdb.connect()
    for name, frame in tables.items():
        con.register(name, frame)
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    got = sorted((tuple(r) for r in df.select(*names).collect()), key=repr)
    assert got == sorted(cursor.fetchall(), key=repr)
    return [dict(zip(names, r)) for r in got]


def test_quotations(spark):
    df = talk(spark, CONVERSATIONS)
    rows = same_as_sql(spark, quotations.conversations(df), quotations.SQL, conversations=df.toArrow())
    by = {(r["conv_id"], r["turn"], r["text"]): r for r in rows}
    second = by[1, 2, "\nDone, still loud."]
    assert (second["parent_turn"], second["n_passages"], second["n_linked"], second["depth"]) == (1, 2, 2, 2)
    assert by[2, 0, "Quoted from elsewhere."]["thread_conv"] == 1
    assert by[1, 1, "Check the oil level first."]["thread_turn"] == 0
    assert by[None, 5, "lost"]["n_linked"] == 0 and (2, 2, None) in by
    smith, quoted, far = (next(r for r in rows if (r["conv_id"], r["turn"]) == (4, k)) for k in (0, 1, 2))
    assert smith["text"].split("\n")[:2] == ["On reflection, as Smith wrote:", "all engines are loud engines."]
    assert smith["text"].endswith("On Tuesday B wrote:") and "Monday" not in smith["text"]
    assert (quoted["parent_conv"], quoted["parent_turn"], quoted["text"]) == (4, 0, "yes")
    assert "écrit" in far["text"] and "On and on wrote:" in far["text"]  # no quote, or one too far behind
    assert [second["place"], by[1, 1, "Check the oil level first."]["place"], by[1, 0, CONVERSATIONS[0][3]]["place"]] == [3, 2, 1]
    assert by[None, 5, "lost"]["place"] == 1
    assert len(rows) == len(CONVERSATIONS)


def test_long_chains_hot_quotes_and_no_rows(spark):
    chain = [(1, k, "user", f"> Message number {k - 1} of many.\nMessage number {k} of many.") for k in range(1, 40)]
    hot = [(5, k, "user", "> Message number 3 of many.\nAll the same.") for k in range(60)]
    df = talk(spark, [(1, 0, "user", "Message number 0 of many."), *chain, *hot, hot[0]])
    rows = same_as_sql(spark, quotations.conversations(df), quotations.SQL, conversations=df.toArrow())
    assert {r["depth"] for r in rows if r["conv_id"] == 1} == set(range(40))
    assert {(r["thread_conv"], r["thread_turn"]) for r in rows} == {(1, 0)}
    assert sorted({r["place"] for r in rows}) == list(range(1, 101))  # 40 messages and 60 answers to one of them
    assert quotations.conversations(talk(spark, [])).count() == 0


def test_licenses(documents):
    texts = [None, "", "Copyright (c) 2020 Somebody", "Not a licence"]
    ids = [None] * 4
    for name, title, body in LICENSES:
        texts += [f"{title or ''}\nCopyright (c) 1999, A. Person\nAll rights reserved.\n\n{body}", body.upper().replace("LICENSE", "LICENCE").replace(",", " ;")]
        ids += [name, name]
    texts.append(LICENSES[0][2] + " And more.")
    ids.append(None)
    df = documents(texts, Digest=["old"] * len(texts))
    found = licenses.scan(df, licenses.known_licenses(df.sparkSession))
    assert found.columns == ["doc_id", "digest", "license"]
    assert [r["license"] for r in found.orderBy("doc_id").collect()] == ids
    same_as_sql(df.sparkSession, found, licenses.sql(), documents=df.toArrow())
    assert licenses.scan(documents([]), licenses.known_licenses(df.sparkSession)).count() == 0


def found_licenses(documents, texts):
    df = documents(texts)
    rows = licenses.scan(df, licenses.known_licenses(df.sparkSession)).orderBy("doc_id").collect()
    return [r["license"] for r in rows]


def test_licenses_at_every_width(documents):
    cases = [(name, width, textwrap.fill(body, width, break_long_words=False)) for name, _, body in LICENSES for width in range(20, 200)]
    cases += [(name, 0, " ".join(body.split())) for name, _, body in LICENSES]
    got = found_licenses(documents, [c[2] for c in cases])
    assert [c[:2] for c, g in zip(cases, got) if g != c[0]] == []


def test_licenses_as_sql_says_them(documents):
    """Copyright statements at several widths, before, behind and inside the texts, with and without line breaks."""
    heads = ["Copyright (c) 2020 Jane Doe ", "(c) Jane Doe, all rights reserved. ", "copyrights © x\n", "Copyright2020 J\n", "Copyrighted 2020\n"]
    heads += ["Copyright notice of it\n", "(c) you must\n", "(C) under\n", " * All rights reserved by A.\n", "-- © ", "Copyright permission is hereby granted\n", ""]
    bodies = [LICENSES[k][2] for k in (0, 3, 6)] + ["Copyright\n2020", "Copyright the work", "the copyright (c) inside"]
    texts = [h + textwrap.fill(b, w, break_long_words=False) for h in heads for b in bodies for w in (40, 67, 200)]
    texts += [b + "\n" + h for h in heads for b in bodies]
    path = Path("/usr/share/common-licenses/Apache-2.0")
    texts += [path.read_text()] * path.exists()
    df = documents(texts)
    found = licenses.scan(df, licenses.known_licenses(df.sparkSession))
    rows = same_as_sql(df.sparkSession, found, licenses.sql(), documents=df.toArrow())
    assert sum(r["license"] is not None for r in rows) > 50


def test_licenses_behind_copyright_statements(documents):
    mit, bsd = (" ".join(LICENSES[k][2].split()) for k in (0, 6))
    heads = ["Copyright (c) 2020 Jane Doe ", "(c) Jane Doe, all rights reserved. ", "Copyright Jane Doe and others. ", "© 2020 J. Doe. All rights reserved. "]
    heads += [h + "\n" for h in (*heads, "Copyright 2010 Foo Project. See AUTHORS for details.", " * Copyright: 2001-2003 The Foo Authors", "(C) 1999 Foo", "Copyright [yyyy] [name]")]
    texts = [h + body for h in heads for body in (mit, bsd)]
    assert found_licenses(documents, texts) == ["MIT", "BSD-3-Clause"] * len(heads)


@pytest.mark.parametrize("file, name", [("Apache-2.0", "Apache-2.0"), ("GPL-3", "GPL-3.0"), ("GPL-2", "GPL-2.0"), ("MPL-2.0", "MPL-2.0"), ("LGPL-2.1", "LGPL-2.1"), ("CC0-1.0", "CC0-1.0")])
def test_full_licenses(documents, file, name):
    path = Path("/usr/share/common-licenses") / file
    if not path.exists():
        pytest.skip("the full texts are not there")
    text = path.read_text()
    parts = text.split("\n\n")

    def filled(width):  # lines of copyright statements stay lines
        return "\n\n".join(p if "opyright (C)" in p or "opyright [" in p else textwrap.fill(p, width, break_long_words=False) for p in parts)

    texts = [text, text.split("END OF TERMS AND CONDITIONS")[0], *map(filled, range(30, 140, 3))]
    assert found_licenses(documents, texts) == [name] * len(texts)
    assert found_licenses(documents, [text[: len(text) // 2]]) == [None]


def test_licenses_known_rows_that_do_not_count(documents, spark):
    known = spark.createDataFrame([("B", "x y"), ("A", "X, y!"), (None, "z"), ("C", None), ("D", "")], "license_id string, text string")
    rows = licenses.scan(documents(["x-y", "z", "", "x y"]), known).orderBy("doc_id").collect()
    assert [r["license"] for r in rows] == ["A", None, None, "A"]


def brute(ids, vectors, own, query, top=10):
    scores = sorted((-int(np.dot(v, query)), i) for i, v in zip(ids, vectors) if i != own)
    return [(i, -s) for s, i in scores[:top]]


@pytest.mark.parametrize("kind", ["spread", "clusters", "copies", "few", "line"])
def test_mtree_equals_brute_force(kind):
    rng = np.random.default_rng(7)
    n, d = {"spread": (3000, 16), "clusters": (3000, 8), "copies": (2500, 4), "few": (3, 5), "line": (2000, 1)}[kind]
    vectors = np.floor(rng.normal(size=(n, d)) * 300)
    if kind == "clusters":
        vectors = np.floor(vectors * 0.05 + rng.normal(size=(12, d))[rng.integers(0, 12, n)] * 900)
    if kind == "copies":
        vectors[n // 3 :] = vectors[0]
    ids = rng.permutation(n * 2)[:n]
    tree = mtree.grow(ids, vectors)
    for i in range(0, n, max(1, n // 25)):
        got = [(-number, score) for score, number in mtree.best(tree, int(ids[i]), vectors[i], 10, float)]
        assert got == brute(ids.tolist(), vectors, int(ids[i]), vectors[i])


class Counted(np.ndarray):
    """Vectors that count how many of their rows are taken into an inner product or a distance."""

    taken = 0

    def __getitem__(self, key):
        out = super().__getitem__(key)
        if isinstance(out, Counted) and out.ndim == 2:
            Counted.taken += len(out)
        return out


@pytest.mark.parametrize("spread, least", [(0.02, 0.8), (0.1, 0.5)])
def test_bounds_spare_most_vectors_where_there_are_clusters(spread, least):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(40, 16))
    vectors = centres[rng.integers(0, 40, 8192)] + spread * rng.normal(size=(8192, 16))
    vectors = np.floor(1024 * vectors / np.linalg.norm(vectors, axis=1, keepdims=True))
    tree = mtree.grow(np.arange(8192), vectors)
    plain = tree.vectors
    tree = tree._replace(vectors=plain.view(Counted))
    Counted.taken = 0
    for i in range(0, 8192, 256):
        got = [score for score, _ in mtree.best(tree, int(tree.ids[i]), plain[i], 10, float)]
        scores = [int(s) for k, s in enumerate(plain @ plain[i]) if k != i]
        assert got == sorted(scores, reverse=True)[:10]
    spared = 1 - Counted.taken / (32 * 8192)
    print(f"spread {spread}: {spared:.2f} of the vectors spared")
    assert spared > least


def test_components_of_any_size_take_part(spark, monkeypatch):
    monkeypatch.setattr(mtree, "TREE", 16)
    rng = random.Random(5)
    rows = [(i, [rng.uniform(-1, 1) * 10 ** rng.choice([0, 0, 3, 6.5, 8, 12]) for _ in range(4)]) for i in range(120)]
    rows += [(200, [3e6, -3e6, 2097152.0, 0.5]), (300, [1e30, 0.0, 0.0, 0.0]), (301, [0.0, 1.0, 2.0, 1e-4]), (302, [-1e30, 0.25, 0.0, 0.0])]
    whole = {i: [math.floor(Fraction(x) * 1024) for x in v] for i, v in rows}
    df = queries.shipped(spark).createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in sorted(mtree.top_k(df, F.col("vec_id") % 100 == 0).collect()):
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    for q in (0, 100, 200, 300):
        scores = [(-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in whole.items() if i != q]
        assert got[q] == [(i, -s) for s, i in sorted(scores) if -(2**63) <= -s < 2**63][:10]


def test_top_k(spark, monkeypatch):
    monkeypatch.setattr(mtree, "TREE", 64)
    rng = random.Random(2)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(6)], "x") for i in range(300)]
    rows += [(i, rows[0][1], "x") for i in range(300, 420)]
    odd = [(500, None, "x"), (501, [1.0, None] * 3, "x"), (502, [float("nan")] * 6, "x"), (503, [float("inf")] * 6, "x"), (505, [None] * 6, "x")]
    odd += [(600, [0.5, 0.5], "x"), (601, [0.25, 1.0], "x"), (None, [0.1] * 6, "x"), rows[100]]
    df = queries.shipped(spark).createDataFrame([*rows, *odd], "vec_id long, embedding array<float>, rank string")
    got = mtree.top_k(df, F.col("vec_id") % 100 == 0)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    found = {}
    for r in sorted(got.collect()):
        found.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    real = [r for r in [*rows, rows[100]]]
    ids = [r[0] for r in real]
    vectors = np.floor(np.array([r[1] for r in real], np.float32).astype(float) * 1024)
    for q in (0, 100, 200, 300, 400):
        assert found.pop(q) == brute(ids, vectors, q, vectors[ids.index(q)])
    assert found == {600: [(601, 512 * 256 + 512 * 1024)]}
    assert mtree.top_k(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0
