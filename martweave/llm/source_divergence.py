"""Operator 13: how far the sources of a language diverge, term by term, in a cube of tasks.

Every language keeps the terms that enough of its documents hold. Of a kept term each
(language, source) group has the share p, in billionths and smoothed, and the language
has the share q; (p - q)^2 / (p + q), floored, is the divergence of two shares.

Counting is one pass: a task cuts terms out of a slice of texts with numpy and hands on
each group's distinct terms with their counts, Spark adds them up by group and term, and
one shuffle by language and term finds which are kept. The kept counts are a written
table.

Pairs of sources are a cube of (group block, group block, term block) cells for each
language. A block of groups and a block of terms are hash ranges of about ``GROUPS`` and
``TERMS`` members, as many as the language needs; a count goes to the cells that need its
slice, one for each block of groups. A cell holds two blocks of groups over one block of
terms, whatever the table, and returns partial divergences, which are added along the
term axis. A term that neither of two sources holds adds the same to every such pair; it
is counted, not sent. Divergence is symmetric, so only cells on or above the diagonal
are built.

The strongest terms of a group are a window whose ten best rows are cut per task before
the shuffle. Nothing of the data comes to the driver.

Defined cases: null text, language and source are ''; a document is a row, so repeated
rows and ids count as often as they occur; a group without terms has its smoothed share
everywhere; a language without kept terms gives pairs of value 0; a language of one
source has no pairs; no documents give no rows; further columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martweave.llm import _kept, _text
from martweave.session import work_folder

LEAST = 10
TOP = 10
UNIT = 1_000_000_000
GROUPS, TERMS = 32, 16384
SLICE = 8_000_000


def term_counts(documents: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """lang, source, term, n (occurrences) and docs (rows that hold it); several rows a term, to be added up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = [batch.column(i).dictionary_encode() for i in (0, 1)]
            code = [x.indices.to_numpy().astype(np.int64) for x in names]
            many = max(len(names[1].dictionary), 1)
            for t in _text.texts(batch.column(2), SLICE):
                data, span = _text.words(t, digits=False)
                if not len(span.start):
                    continue
                first, which = _kept.distinct(data, span.start, span.end)
                # Rows in the order of their groups, so that a term's groups lie together.
                group = code[0][t.first : t.last] * many + code[1][t.first : t.last]
                order = np.argsort(group, kind="stable")
                rank = np.empty(len(order), np.int64)
                rank[order] = np.arange(len(order))
                row = np.repeat(rank, np.diff(span.row))
                key, times = np.unique(which.astype(np.int64) * len(order) + row, return_counts=True)
                term, own = key // len(order), group[order][key % len(order)]
                new = np.flatnonzero(np.concatenate([[True], (term[1:] != term[:-1]) | (own[1:] != own[:-1])]))
                start, size = span.start[first], span.end[first] - span.start[first]
                at = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
                spelled = pa.StringArray.from_buffers(
                    len(first), pa.py_buffer(at), pa.py_buffer(data[_text.ranges(start, size)])
                )
                columns = [
                    names[0].dictionary.take(pa.array(own[new] // many)),
                    names[1].dictionary.take(pa.array(own[new] % many)),
                    spelled.take(pa.array(term[new])),
                    pa.array(np.add.reduceat(times, new), pa.int64()),
                    pa.array(np.diff(np.append(new, len(key))), pa.int64()),
                ]
                for k in range(0, len(new), 100_000):
                    yield pa.RecordBatch.from_arrays(
                        [c.slice(k, 100_000) for c in columns], names=["lang", "source", "term", "n", "docs"]
                    )

    return _plain(documents, text, lang, source).mapInArrow(run, "lang string, source string, term string, n long, docs long")


def _plain(documents: DataFrame, text: str, lang: str, source: str) -> DataFrame:
    return documents.select(
        *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a) for c, a in ((lang, "lang"), (source, "source"), (text, "text")))
    )


def kept_counts(counts: DataFrame, least: int = LEAST) -> DataFrame:
    """lang, source, term, n, n_lang of the terms that ``least`` documents of a language hold; ``one`` is 1 once a term."""
    added = counts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    term = Window.partitionBy("lang", "term")
    place = F.row_number().over(term.orderBy("source"))
    both = added.select(
        "lang", "source", "term", "n",
        F.sum("n").over(term).alias("n_lang"), F.sum("docs").over(term).alias("held"), (place == 1).cast("long").alias("one"),
    )
    return both.where(F.col("held") >= least).drop("held")


def group_totals(documents: DataFrame, kept: DataFrame) -> DataFrame:
    """lang, source, n_group of every group, and of its language n_all, terms and sources."""
    some = kept.groupBy("lang", "source").agg(F.sum("n").alias("n_group"), F.sum("one").alias("ones"))
    groups = documents.distinct().join(some, ["lang", "source"], "left").na.fill(0, ["n_group", "ones"])
    of = Window.partitionBy("lang")
    return groups.select(
        "lang", "source", "n_group",
        F.sum("n_group").over(of).alias("n_all"), F.sum("ones").over(of).alias("terms"), F.count("source").over(of).alias("sources"),
    )


def _share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(10^9 * (n + 2) / (total + 2 * terms)), in decimals, as longs may be too small."""
    top = (n + 2).cast("decimal(20,0)") * F.lit(UNIT).cast("decimal(10,0)")
    return F.call_function("div", top, (total + 2 * terms).cast("decimal(20,0)")) + 1


def _divergence(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def strongest_terms(kept: DataFrame, groups: DataFrame, top: int = TOP) -> DataFrame:
    """lang, source, item (a term that a group has more of than its language), value, rank up to ``top``."""
    share = kept.join(groups, ["lang", "source"]).select(
        "lang", "source", F.col("term").alias("item"),
        _share(F.col("n"), F.col("n_group"), F.col("terms")).alias("p"),
        _share(F.col("n_lang"), F.col("n_all"), F.col("terms")).alias("q"),
    )
    found = share.where("p > q").select("lang", "source", "item", _divergence(F.col("p"), F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


_CELL = "lang string, a string, b string, part long, seen long, rest long, terms long"


def _shares(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    if count.size and int(count.max()) + 2 >= 2**63 // UNIT:
        return ((count.astype(object) + 2) * UNIT // total[:, None] + 1).astype(np.int64)
    return (count + 2) * UNIT // total[:, None] + 1


def _cell(key: tuple, table: pa.Table) -> pa.Table:
    """Partial divergences of all pairs of sources of a cell's two blocks over its terms."""
    lang, block = key[0].as_py(), (key[1].as_py(), key[2].as_py())
    header = table.filter(pa.compute.is_null(table["term"]))
    counts = table.filter(pa.compute.is_valid(table["term"]))
    name = header["source"].to_pylist()
    where = {s: i for i, s in enumerate(name)}
    own = header["own"].to_numpy()
    terms = header["terms"].to_numpy()
    total = np.maximum(header["n_group"].to_numpy() + 2 * terms, 1)
    term = counts["term"].combine_chunks().dictionary_encode()
    source = counts["source"].combine_chunks().dictionary_encode()
    line = np.array([where[s] for s in source.dictionary.to_pylist()], np.int64)
    count = np.zeros((len(name), len(term.dictionary)), np.int64)
    if len(term):
        count[line[source.indices.to_numpy()], term.indices.to_numpy()] = counts["n"].to_numpy()
    p = _shares(count, total).astype(np.uint64)
    none = _shares(np.zeros((len(name), 1), np.int64), total)[:, 0].astype(np.uint64)
    left, right = (np.flatnonzero(own == x) for x in block)
    out = []
    for i in left.tolist():
        other = right[right > i] if block[0] == block[1] else right
        if not len(other):
            continue
        q, q_none = p[other], none[other]
        far = np.where(q > p[i], q - p[i], p[i] - q)
        part = (far * far // (q + p[i])).sum(1, dtype=np.uint64)
        far = np.where(q_none > none[i], q_none - none[i], none[i] - q_none)
        rest = far * far // (q_none + none[i])
        for j, value, alone in zip(other.tolist(), part.tolist(), rest.tolist()):
            out.append((lang, name[i], name[j], value, p.shape[1], alone, int(terms[i])))
    columns = zip(*out) if out else [[]] * 7
    kinds = [pa.string()] * 3 + [pa.int64()] * 4
    return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[c.split()[0] for c in _CELL.split(", ")])


def source_pairs(kept: DataFrame, groups: DataFrame, group_block: int = GROUPS, term_block: int = TERMS) -> DataFrame:
    """lang, source, item (another source of the language), value, rank."""
    blocks = F.greatest(F.lit(1), F.ceil(F.col("sources") / group_block)).cast("long")
    slices = F.greatest(F.lit(1), F.ceil(F.col("terms") / term_block)).cast("long")
    sized = groups.select(
        "lang", "source", "n_group", "terms", blocks.alias("blocks"), slices.alias("slices"),
        F.pmod(F.xxhash64("source"), blocks).alias("own"),
    )

    def replicated(df: DataFrame, term: Column, n: Column, at: Column) -> DataFrame:
        each = df.select("*", at.alias("slice"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"))
        return each.select(
            "lang", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "slice",
            "source", "own", "n_group", "terms", term.alias("term"), n.alias("n"),
        )

    heads = replicated(
        sized, F.lit(None).cast("string"), F.lit(None).cast("long"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)),
    )
    counts = replicated(
        kept.select("lang", "source", "term", "n").join(sized, ["lang", "source"]),
        F.col("term"), F.col("n"), F.pmod(F.xxhash64("term"), F.col("slices")),
    )
    cells = heads.union(counts).groupBy("lang", "low", "high", "slice").applyInArrow(_cell, _CELL)
    pairs = cells.groupBy("lang", "a", "b").agg(
        (F.sum("part") + (F.max("terms") - F.sum("seen")) * F.max("rest")).alias("value")
    )
    both = pairs.select("lang", "value", F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("x"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    named = both.select("lang", F.col("x.a").alias("source"), F.col("x.b").alias("item"), "value")
    return named.withColumn("rank", F.row_number().over(order))


def audit(
    documents: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
    least: int = LEAST, top: int = TOP, group_block: int = GROUPS, term_block: int = TERMS,
) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value, rank."""
    spark = documents.sparkSession
    counted, totals = work_folder(spark, "divergence_counts"), work_folder(spark, "divergence_groups")
    kept_counts(term_counts(documents, text, lang, source), least).write.parquet(counted)
    kept = spark.read.parquet(counted)
    group_totals(_plain(documents, text, lang, source).select("lang", "source"), kept).write.parquet(totals)
    groups = spark.read.parquet(totals)
    parts = (("pair", source_pairs(kept, groups, group_block, term_block)), ("term", strongest_terms(kept, groups, top)))
    one, two = (df.select("lang", "source", F.lit(name).alias("part"), "item", "value", "rank") for name, df in parts)
    return one.union(two)


SQL = r"""
    WITH d AS (
        SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
        FROM documents
    ),
    w AS (SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
    c AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT r) AS docs FROM w GROUP BY ALL),
    k AS MATERIALIZED (SELECT lang, term, sum(n) AS n FROM c GROUP BY ALL HAVING sum(docs) >= 10),
    v AS (SELECT lang, count(*) AS terms, sum(n) AS n FROM k GROUP BY lang),
    g AS MATERIALIZED (
        SELECT x.lang, x.source, coalesce(v.terms, 0) AS terms, coalesce(v.n, 0) AS n_all,
               coalesce((SELECT sum(c.n) FROM c JOIN k USING (lang, term) WHERE c.lang = x.lang AND c.source = x.source), 0) AS n_group
        FROM (SELECT DISTINCT lang, source FROM d) x LEFT JOIN v USING (lang)
    ),
    s AS MATERIALIZED (
        SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
               1 + ((1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (g.n_group + 2 * g.terms)::HUGEINT) AS p,
               1 + ((1000000000::HUGEINT * (k.n + 2)) // (g.n_all + 2 * g.terms)::HUGEINT) AS q
        FROM g JOIN k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
    ),
    pair AS (
        SELECT a.lang, a.source, b.source AS item, coalesce(f.value, 0) AS value
        FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
        LEFT JOIN (
            SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
            FROM s a JOIN s b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
            GROUP BY ALL
        ) f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
    ),
    parts AS (
        SELECT lang, source, 'pair' AS part, item, value FROM pair
        UNION ALL
        SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) FROM s WHERE n > 0 AND p > q
    ),
    ranked AS (
        SELECT lang, source, part, item, value::BIGINT AS value,
               (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
        FROM parts
    )
    SELECT * FROM ranked WHERE part = 'pair' OR rank <= 10
"""
