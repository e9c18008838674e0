"""Operator 2: recognise whole texts that are known licences by their canonical digest.

A text is put into small letters, its copyright statements go, everything that is neither a
letter nor a digit becomes one blank, and equivalent spellings become one. The SHA-256 of
what is left is looked up among the digests of known licences, made the same way, each
with and without its title. One hash join on the digest; the texts stay where they are.

Nothing but DataFrame functions. The known side is one row for each digest and left to
the planner: small, it is broadcast by Spark's own size limit; large, digests are
shuffled and a digest that a third of the documents share may be split.

A copyright statement starts a line: the sign, or the word followed by a sign, a year or
a holder, up to the line's end or the start of a known text on the same line. The word
inside a sentence ("copyright notice", "copyright holders") is text wherever a line is
wrapped. The SQL says the same line by line, as its patterns cannot look ahead.

Result: the columns of the documents other than ``text``, and ``digest`` and ``license``
(null if unknown), which replace columns of those names, whatever their case. Defined
cases: a null or empty text, or one of copyright statements only, has the digest of nothing
and no licence; two licences with one digest give the id that sorts first; rows stay one
to one, repeated ones too; known rows with a null id or text do not count.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martweave.llm.license_texts import DIGESTS, LICENSES

# Spellings that count as equal, in small letters, with blanks for signs.
SPELLINGS = [
    (r"(^| )(sub|)licenc(e|es|ed|ee|ees|ing)", r"\1\2licens\3"),
    (r"(^| )sub licens", r"\1sublicens"),
    (r"(^| )non (commercial|exclusive|infringement|infringing)", r"\1non\2"),
    (r"(^| )(author|organ|recogn|util|real|minim|initial|merchand)is(e|ed|es|er|ers|ing|ation|ations)", r"\1\2iz\3"),
    (r"(^| )(fav|hon|behavi|lab)our", r"\1\2or"),
    (r"(^| )acknowledgement", r"\1acknowledgment"),
    (r"(^| )copyright owner", r"\1copyright holder"),
    (r"(^| )whilst", r"\1while"),
    (r"(^| )per cent", r"\1percent"),
    (r"(^| )http ", r"\1https "),
]
#: What may follow the word, or the sign in brackets, inside a sentence or a list.
_IN_TEXT = (
    r"and|are|disclaimer|doctrines|holders?|if|in|interests?|is|laws?|licen[cs]es?|like|line|notices?|of|on|or|owners?"
    r"|ownership|patents?|permissions?|resulting|statements?|the (?:library|software|program|work)|those|to|treaty|also"
)
_LISTED = r"you must|the licenses|representations|under"


def _starts() -> str:
    """The first words of the known texts, by which one is found behind a statement on its line."""
    firsts = {tuple(re.findall(r"\w+", t.lower())[:4]) for _, title, body in LICENSES for t in (title, body) if t}
    return "|".join(r"[^\p{L}\p{N}\n]+".join(f) for f in sorted({*firsts, ("everyone", "is", "permitted", "to")}))


COPYRIGHT = (
    r"(^|\n)[^\p{L}\p{N}\n]*"
    r"(?:all rights reserved|©|\(c\)(?![^\p{L}\p{N}\n]*(?:" + _LISTED + r")\b)"
    r"|copyrights?(?!\p{L})[^\p{L}\p{N}\n]*(?:\(c\)|©|(?!(?:" + _IN_TEXT + r")\b)[\p{L}\p{N}]))"
    r"[^\n]*?(?=\n|\z|(?<![\p{L}\p{N}])(?:" + _starts() + r")\b)"
)
SIGNS = r"[^\p{L}\p{N}]+"


def canonical(text: Column) -> Column:
    """The text without copyright statements, case, signs and differences of spelling."""
    out = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), COPYRIGHT, "\n")
    out = F.trim(F.regexp_replace(out, SIGNS, " "))
    for pattern, spelling in SPELLINGS:
        out = F.regexp_replace(out, pattern, spelling.replace("\\", "$"))
    return out


def digest(text: Column) -> Column:
    return F.sha2(canonical(text), 256)


def known_licenses(spark: SparkSession) -> DataFrame:
    """license_id and text of the licences that come with the library; of long ones license_id and digest."""
    texts = [
        (name, text) for name, title, body in LICENSES for text in ([body] if title is None else [body, f"{title}\n\n{body}"])
    ]
    texts = [(a, b, None) for a, b in texts] + [(name, None, known) for name, every in DIGESTS.items() for known in every]
    rows = F.array(
        *(
            F.struct(F.lit(a).alias("license_id"), F.lit(b).cast("string").alias("text"), F.lit(c).cast("string").alias("digest"))
            for a, b, c in texts
        )
    )
    return spark.range(1).select(F.inline(rows))


def scan(documents: DataFrame, known: DataFrame) -> DataFrame:
    """The documents with their digest and licence; ``known``: license_id, text and perhaps the digest instead of it."""
    own = F.when(F.col("text").isNotNull(), digest(F.col("text")))
    own = F.coalesce(F.col("digest"), own) if "digest" in known.columns else own
    usable = known.select("license_id", own.alias("_known")).where("license_id IS NOT NULL AND _known IS NOT NULL")
    digests = usable.groupBy("_known").agg(F.min("license_id").alias("license"))
    digests = digests.where(F.col("_known") != F.sha2(F.lit(""), 256))
    made = ("text", "digest", "license")
    kept = documents.select(
        *(f"`{c}`" for c in documents.columns if c.lower() not in made), digest(documents["text"].cast("string")).alias("digest")
    )
    return kept.join(digests, kept["digest"] == digests["_known"], "left").drop("_known")


def _sql_line() -> str:
    """The same as ``COPYRIGHT`` for one line ``x``: what is left of it."""
    sign = r"[^\p{L}\p{N}]*"
    word = rf"^{sign}copyrights?"
    statement = " OR ".join(
        (
            rf"regexp_matches(x, '^{sign}(all rights reserved|©)')",
            rf"(regexp_matches(x, '^{sign}\(c\)') AND NOT regexp_matches(x, '^{sign}\(c\){sign}({_LISTED})\b'))",
            rf"regexp_matches(x, '{word}{sign}(\(c\)|©)')",
            rf"(regexp_matches(x, '{word}([^\p{{L}}\p{{N}}]+[\p{{L}}\p{{N}}]|\p{{N}})') AND NOT regexp_matches(x, '{word}{sign}({_IN_TEXT})\b'))",
        )
    )
    head = rf"^{sign}(?:all rights reserved|©|\(c\)|copyrights?{sign}(?:\(c\)|©|[\p{{L}}\p{{N}}]))"
    behind = rf"{head}(?:[^\n]*?[^\p{{L}}\p{{N}}])??((?:{_starts()})\b[^\n]*)$"
    return f"CASE WHEN {statement} THEN regexp_extract(x, '{behind}', 1) ELSE x END"


def _sql_canonical(text: str) -> str:
    lines = f"list_transform(string_split(lower(coalesce({text}, '')), chr(10)), lambda x: {_sql_line()})"
    out = f"trim(regexp_replace(array_to_string({lines}, chr(10)), '{SIGNS}', ' ', 'g'))"
    for pattern, spelling in SPELLINGS:
        out = f"regexp_replace({out}, '{pattern}', '{spelling}', 'g')"
    return f"sha256({out})"


def sql() -> str:
    values = ", ".join(
        "('{}', '{}')".format(name, text.replace("'", "''"))
        for name, title, body in LICENSES
        for text in ([body] if title is None else [body, f"{title}\n\n{body}"])
    )
    digests = ", ".join(f"('{name}', '{known}')" for name, every in DIGESTS.items() for known in every)
    return f"""
        WITH known AS (
            SELECT digest, min(license_id) AS license FROM (
                SELECT {_sql_canonical('text')} AS digest, license_id FROM (VALUES {values}) v(license_id, text)
                UNION ALL SELECT digest, license_id FROM (VALUES {digests}) w(license_id, digest)
            ) GROUP BY digest
        )
        SELECT doc_id, d.digest, license
        FROM (SELECT doc_id, {_sql_canonical('text')} AS digest FROM documents) d LEFT JOIN known USING (digest)
    """
