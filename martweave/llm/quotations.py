"""Operator 1: link quoted passages to their messages and order conversations by reply.

A line's quote level is the number of ``>`` it starts with. A line that says who wrote
what ("On Monday X wrote:") is dropped if the next line that is not blank, ``BLANKS`` blank
ones later at most, is quoted more deeply; anywhere else it is text like any other. The
rest of a message falls into passages, runs of lines of one level. Passages are normalised (small letters, signs and white space to
one blank) and hashed. What stands at level 0 is original text, as a passage and, if it
has ``LINE_WORDS`` words or more, as a line, so that a quote of a part is found too.

A quoted passage is linked to the first message with that text: in its own conversation,
else anywhere before it (by conv_id, then turn). Its whole is tried first, then its lines
in order. A message answers what its last linked passage of level 1 comes from; answers
lead to the root of a thread. As a parent always comes before its answer by (conv_id,
turn), the rows of a thread in that order are its conversation in order of reply, without
quotes; ``place`` counts them. It comes from a sort over the cluster, so a thread of any
size is spread over tasks.

All of it is DataFrame functions. The texts are cut inside their rows; originals are
reduced to one row for each hash (in each conversation) before any join, partly in each
task, so joins meet one row and their other side may be split. Roots are found by
doubling: each step joins answers to what they answer, so the longest chain of n answers
takes log2(n) steps; every step is a written table in the shared folder, which goes when the
next one is written.

Result: conv_id, turn, role, text (without quotes), n_passages (quoted), n_linked,
parent_conv, parent_turn, thread_conv, thread_turn, depth, place (from 1). Defined cases: a null text is
kept null and quotes nothing; a blank passage links to nothing; a row without conv_id or
turn answers nothing, is quoted by nobody and is its own thread; rows with the same
conv_id and turn are one message with all their passages and one place, and stay rows of their own;
further columns are left out; no rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martweave.session import remove, work_folder

LINE_WORDS = 3
MARKS = r"^((?:[ \t]*>)+)"
CONTENT = r"^(?:[ \t]*>)+ ?"
BLANKS = 50
# Fixed value: who-wrote-what lines in four languages.
ATTRIBUTION = r"[ \t]*(?:On|Am|Le|El)[ \t][^\n]{0,300}(?:wrote|schrieb|écrit|escribió)[^:\n]{0,100}:[ \t\r]*"
#: Such a line before a deeper quote, where the marks of a line stand together.
INTRODUCTION = (
    rf"(?md)^(>*){ATTRIBUTION}\n(?=(?:>*[ \t\r]*\n){{0,{BLANKS}}}\1>(?!>*[ \t\r]*(?:\n|\z)))"
)


def _normal(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def _once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with a column that is made once for each row.

    The planner would put the expression wherever the column is used, in lambdas too; a
    generator of one row is in its way.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def parsed(messages: DataFrame) -> DataFrame:
    """``messages`` with ``plain`` (text without quotes) and ``passages`` (level, lines)."""
    together = F.transform(
        F.split(F.coalesce("text", F.lit("")), "\n"),
        lambda x: F.concat(F.regexp_replace(F.regexp_extract(x, MARKS, 1), "[^>]", ""), F.regexp_replace(x, CONTENT, "")),
    )
    marked = F.transform(
        F.split(F.regexp_replace(F.array_join(together, "\n"), INTRODUCTION, ""), "\n"),
        lambda x: F.struct(
            F.length(F.regexp_extract(x, "^>*", 0)).alias("level"), F.regexp_replace(x, "^>+", "").alias("content")
        ),
    )
    n = F.size("marked")
    starts = F.filter(
        F.sequence(F.lit(1), F.greatest(n, F.lit(1))),
        lambda i: (n > 0) & ((i == 1) | (F.col("marked")[i - 1]["level"] != F.col("marked")[i - 2]["level"])),
    )
    ends = F.concat(F.slice("starts", F.lit(2), F.greatest(F.size("starts"), F.lit(1))), F.array(n + 1))
    passages = F.transform(
        "starts",
        lambda s, k: F.struct(
            F.col("marked")[s - 1]["level"].alias("level"),
            F.transform(F.slice("marked", s, F.col("ends")[k] - s), lambda x: x["content"]).alias("lines"),
        ),
    )
    plain = F.array_join(F.transform(F.filter("marked", lambda x: x["level"] == 0), lambda x: x["content"]), "\n")
    cut = _once(_once(_once(messages, "marked", marked), "starts", starts).withColumn("ends", ends), "passages", passages)
    return cut.withColumn("plain", F.when(F.col("text").isNotNull(), plain)).drop("marked", "starts", "ends")


def _units(passages: DataFrame) -> DataFrame:
    """Of each passage its whole (unit 0) and its longer lines: hashes of what is not blank."""
    whole = _normal(F.array_join("passage.lines", " "))
    parts = F.transform(
        F.transform("passage.lines", _normal), lambda x: F.when(F.size(F.split(x, " ")) >= LINE_WORDS, x).otherwise("")
    )
    units = passages.select("conv_id", "turn", "place", "passage.level", F.posexplode(F.concat(F.array(whole), parts)).alias("unit", "said"))
    return units.where("said != ''").withColumn("hash", F.unhex(F.md5("said"))).drop("said")


def linked(passages: DataFrame) -> DataFrame:
    """conv_id, turn, place, level and from_conv, from_turn of each quoted passage that is found."""
    spark = passages.sparkSession
    folder = work_folder(spark, "units")
    _units(passages).write.parquet(folder)  # texts are cut once
    units = spark.read.parquet(folder)
    inside = units.where("level = 0").groupBy("conv_id", "hash").agg(F.min("turn").alias("own_turn"))
    first = F.min(F.struct("conv_id", F.col("own_turn").alias("turn")))
    anywhere = inside.groupBy("hash").agg(first.alias("first"))
    quotes = units.where("level > 0").distinct()
    found = (
        quotes.join(inside, ["conv_id", "hash"], "left")
        .join(anywhere, "hash", "left")
        .withColumn(
            "source",
            F.when(F.col("own_turn") < F.col("turn"), F.struct("conv_id", F.col("own_turn").alias("turn"))).when(
                F.col("first") < F.struct("conv_id", "turn"), F.col("first")
            ),
        )
        .where("source IS NOT NULL")
    )
    best = found.groupBy("conv_id", "turn", "place", "level").agg(F.min_by("source", "unit").alias("source"))
    return best.select("conv_id", "turn", "place", "level", F.col("source.conv_id").alias("from_conv"), F.col("source.turn").alias("from_turn"))


def roots(answers: DataFrame) -> DataFrame:
    """conv_id, turn, thread_conv, thread_turn, depth of messages with a parent (up_conv, up_turn)."""
    spark = answers.sparkSession
    now = answers.withColumn("depth", F.lit(1).cast("long"))
    before = None
    while True:
        folder = work_folder(spark, "threads")
        now.write.parquet(folder)
        now = spark.read.parquet(folder)
        if before is not None:
            remove(spark, before)
        before = folder
        above = now.select(
            F.col("conv_id").alias("up_conv"),
            F.col("turn").alias("up_turn"),
            F.col("up_conv").alias("next_conv"),
            F.col("up_turn").alias("next_turn"),
            F.col("depth").alias("more"),
        )
        joined = now.join(above, ["up_conv", "up_turn"], "left")
        if joined.where("more IS NOT NULL").isEmpty():
            return now.withColumnsRenamed({"up_conv": "thread_conv", "up_turn": "thread_turn"})
        now = joined.select(
            "conv_id",
            "turn",
            F.coalesce("next_conv", "up_conv").alias("up_conv"),
            F.coalesce("next_turn", "up_turn").alias("up_turn"),
            (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
        )


def placed(answers: DataFrame) -> DataFrame:
    """conv_id, turn, thread_conv, thread_turn, depth and place of all messages of threads with answers."""
    spark = answers.sparkSession
    threads = roots(answers).select("conv_id", "turn", "thread_conv", "thread_turn", "depth")
    first = threads.select("thread_conv", "thread_turn").distinct()
    opening = first.select(F.col("thread_conv").alias("conv_id"), F.col("thread_turn").alias("turn"), "*", F.lit(0).cast("long").alias("depth"))
    order = ["thread_conv", "thread_turn", "conv_id", "turn"]
    ordered = threads.union(opening).repartitionByRange(*order).sortWithinPartitions(*order)
    folder = work_folder(spark, "places")
    ordered.withColumn("at", F.monotonically_increasing_id()).write.parquet(folder)
    stored = spark.read.parquet(folder).withColumns(
        {"part": F.shiftright("at", 33), "within": F.col("at").bitwiseAND(F.lit((1 << 33) - 1))}
    )
    parts = stored.groupBy("part").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ahead = parts.select("part", before.alias("ahead"))  # a row for each task that wrote
    ranked = stored.join(F.broadcast(ahead), "part").withColumn("rank", F.col("ahead") + F.col("within"))
    starts = ranked.groupBy("thread_conv", "thread_turn").agg(F.min("rank").alias("first"))
    found = ranked.join(starts, ["thread_conv", "thread_turn"])
    return found.select("conv_id", "turn", "thread_conv", "thread_turn", "depth", (F.col("rank") - F.col("first") + 1).alias("place"))


def conversations(messages: DataFrame) -> DataFrame:
    """The messages without quotes, with their links and threads."""
    kept = messages.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", F.col("text").cast("string"))
    cut = parsed(kept)
    known = cut.where("conv_id IS NOT NULL AND turn IS NOT NULL")
    passages = known.select("conv_id", "turn", F.posexplode("passages").alias("place", "passage"))
    folder = work_folder(messages.sparkSession, "quotations")
    linked(passages).write.parquet(folder)
    found = messages.sparkSession.read.parquet(folder)
    parent = F.max_by(F.struct("from_conv", "from_turn"), F.when(F.col("level") == 1, F.col("place")))
    per_message = found.groupBy("conv_id", "turn").agg(F.count("*").alias("n_linked"), parent.alias("parent"))
    links = per_message.select(
        "conv_id", "turn", "n_linked", F.col("parent.from_conv").alias("parent_conv"), F.col("parent.from_turn").alias("parent_turn")
    )
    answers = links.where("parent_conv IS NOT NULL").select(
        "conv_id", "turn", F.col("parent_conv").alias("up_conv"), F.col("parent_turn").alias("up_turn")
    )
    return (
        cut.join(links, ["conv_id", "turn"], "left")
        .join(placed(answers), ["conv_id", "turn"], "left")
        .select(
            "conv_id",
            "turn",
            "role",
            F.col("plain").alias("text"),
            F.size(F.filter("passages", lambda p: p["level"] > 0)).cast("long").alias("n_passages"),
            F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"),
            "parent_conv",
            "parent_turn",
            F.coalesce("thread_conv", "conv_id").alias("thread_conv"),
            F.coalesce("thread_turn", "turn").alias("thread_turn"),
            F.coalesce("depth", F.lit(0)).cast("long").alias("depth"),
            F.coalesce("place", F.lit(1)).cast("long").alias("place"),
        )
    )


_NORMAL = "trim(regexp_replace(lower({}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"
_WHOLE = _NORMAL.format("array_to_string(p.lines, ' ')")
_LINE = _NORMAL.format("x")
SQL = f"""
    WITH RECURSIVE m AS (
        SELECT row_number() OVER () AS id, conv_id::BIGINT AS conv_id, turn::BIGINT AS turn, role, text,
               list_transform(string_split(coalesce(text, ''), chr(10)),
                   lambda x: {{'level': length(regexp_replace(regexp_extract(x, '{MARKS}', 1), '[^>]', '', 'g')),
                               'content': regexp_replace(x, '{CONTENT}', '')}}) AS marked
        FROM conversations
    ),
    every AS (SELECT id, conv_id, turn, unnest(marked) AS line, generate_subscripts(marked, 1) AS n FROM m),
    said AS (
        SELECT id, n, line.level AS level, regexp_full_match(line.content, '{ATTRIBUTION}') AS says,
               lead(line.level) OVER w AS next_level, lead(n) OVER w AS next_n
        FROM every WHERE NOT regexp_full_match(line.content, '[ \t\r]*')
        WINDOW w AS (PARTITION BY id ORDER BY n)
    ),
    l AS (
        SELECT * FROM every e WHERE NOT EXISTS (
            SELECT 1 FROM said s WHERE s.id = e.id AND s.n = e.n AND says AND next_level > level AND next_n - s.n - 1 <= {BLANKS})
    ),
    cut AS (
        SELECT *, CASE WHEN lag(line.level) OVER w IS DISTINCT FROM line.level THEN 1 ELSE 0 END AS new
        FROM l WINDOW w AS (PARTITION BY id ORDER BY n)
    ),
    numbered AS (SELECT *, sum(new) OVER (PARTITION BY id ORDER BY n) - 1 AS place FROM cut),
    p AS (
        SELECT id, conv_id, turn, place, any_value(line.level) AS level, list(line.content ORDER BY n) AS lines
        FROM numbered GROUP BY ALL
    ),
    u AS (
        SELECT DISTINCT conv_id, turn, place, level, generate_subscripts(s, 1) AS unit, unnest(s) AS said
        FROM (
            SELECT p.*, list_concat([{_WHOLE}],
                list_transform(lines, lambda x: CASE WHEN len(string_split({_LINE}, ' ')) >= {LINE_WORDS} THEN {_LINE} ELSE '' END)
            ) AS s
            FROM p WHERE conv_id IS NOT NULL AND turn IS NOT NULL
        )
    ),
    o AS (SELECT * FROM u WHERE level = 0 AND said <> ''),
    inside AS (SELECT conv_id, said, min(turn) AS own_turn FROM o GROUP BY ALL),
    anywhere AS (SELECT said, min(ROW(conv_id, turn)) AS first FROM o GROUP BY ALL),
    f AS (
        SELECT u.conv_id, u.turn, place, level, unit,
               CASE WHEN own_turn < u.turn THEN ROW(u.conv_id, own_turn)
                    WHEN first < ROW(u.conv_id, u.turn) THEN first END AS source
        FROM u LEFT JOIN inside i ON i.conv_id = u.conv_id AND i.said = u.said
        LEFT JOIN anywhere a ON a.said = u.said
        WHERE level > 0 AND u.said <> ''
    ),
    linked AS (
        SELECT conv_id, turn, place, level, arg_min(source, unit) AS source
        FROM f WHERE source IS NOT NULL GROUP BY ALL
    ),
    links AS (
        SELECT conv_id, turn, count(*) AS n_linked, arg_max(source, place) FILTER (level = 1) AS parent
        FROM linked GROUP BY ALL
    ),
    up AS (
        SELECT conv_id, turn, parent[1] AS thread_conv, parent[2] AS thread_turn, 1 AS depth
        FROM links WHERE parent IS NOT NULL
        UNION ALL
        SELECT up.conv_id, up.turn, l.parent[1], l.parent[2], depth + 1
        FROM up JOIN links l ON l.conv_id = thread_conv AND l.turn = thread_turn AND l.parent IS NOT NULL
    ),
    r AS (
        SELECT conv_id, turn, arg_max(thread_conv, depth) AS thread_conv, arg_max(thread_turn, depth) AS thread_turn,
               max(depth) AS depth
        FROM up GROUP BY ALL
    )
    SELECT m.conv_id, m.turn, m.role,
           CASE WHEN text IS NOT NULL THEN coalesce(
               (SELECT string_agg(line.content, chr(10) ORDER BY n) FROM l WHERE l.id = m.id AND line.level = 0), '') END AS text,
           (SELECT count(*) FROM p WHERE p.id = m.id AND p.level > 0) AS n_passages,
           coalesce(n_linked, 0) AS n_linked, parent[1] AS parent_conv, parent[2] AS parent_turn,
           coalesce(thread_conv, m.conv_id) AS thread_conv, coalesce(thread_turn, m.turn) AS thread_turn,
           coalesce(depth, 0)::BIGINT AS depth,
           CASE WHEN m.conv_id IS NULL OR m.turn IS NULL THEN 1 ELSE dense_rank() OVER (
               PARTITION BY coalesce(thread_conv, m.conv_id), coalesce(thread_turn, m.turn) ORDER BY m.conv_id, m.turn) END AS place
    FROM m LEFT JOIN links USING (conv_id, turn) LEFT JOIN r USING (conv_id, turn)
"""
