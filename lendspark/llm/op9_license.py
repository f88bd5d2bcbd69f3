"""Licence scan by canonical digest lookup.

A text is normalised (ASCII case, copyright notices, punctuation and white
space, equivalent spellings) and hashed; the digest of the entire text is
hash-joined to the digests of known licence texts. The same lookup runs for
every whole line, since documents often end in a one-line notice.

Only DataFrame functions are used. The known table is a parameter of at most
``MAX_KNOWN`` rows (checked), so its broadcast has a proven bound.

A notice stands at a line's start: 'copyright' and a sign, a year or a holder,
a sign and a year, or 'all rights reserved' alone. Words that follow
'copyright' in licence texts ('notice', 'holders', ...) are no holder, since
wrapped lines begin with them. The notice ends with the line, or where a
listed text begins on the same line.

Defined cases: a null text has a null digest and no licence; a text without
letters or digits (also the empty one) has the digest of '' and no licence;
rows repeated with equal id and text each give a row with the same result;
an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, stage, table
from .licenses import KNOWN, SPELLINGS

MAX_KNOWN = 10_000
# First words of the listed texts.
_STARTS = sorted({tuple(re.findall("[a-z0-9]+", t.split("\n")[0].lower())[:3]) for _, t in KNOWN})
_START = "(?<![a-z0-9])(?:" + "|".join("[^a-z0-9\\n]+".join(x).replace("license", "licen[sc]e") for x in _STARTS) + ")(?![a-z0-9])"
_YEAR = r"(?:19|20)\d\d"
_BODY = r"(?:notices?|holders?|owners?|laws?|licen[sc]es?|statements?|permissions?|protection|infringements?|interests?|rights?|works?|terms?|disclaimers?|and|or|in|of|to|is|are|as)(?![a-z0-9])"
_NOTICE = (
    rf"copyright[ \t:,]*(?:\(c\)|©|{_YEAR}|[<\[{{])|copyright[ \t]+(?!{_BODY})[^\s\x00-\x2F]"
    rf"|\(c\)[ \t]*(?:copyright[ \t]|{_YEAR}|by[ \t])|©|all rights reserved[^a-z0-9\n]*(?=\n|\z|{_START})"
)
COPYRIGHT_LINE = rf"(^|\n)[ \t]*(?:{_NOTICE})[^\n]*?(?=\n|\z|{_START})"
NOT_WORD = r"[\x00-\x09\x0B-\x2F\x3A-\x60\x7B-\x7F]+"


def canonical_lines(text: Column) -> Column:
    """The normalised text with line ends kept."""
    t = F.regexp_replace(ascii_lower(text), COPYRIGHT_LINE, "\n")
    t = F.regexp_replace(t, NOT_WORD, " ")
    for old, new in SPELLINGS:
        t = F.replace(t, F.lit(old), F.lit(new))
    return t


def one_line(canonical: Column) -> Column:
    return F.trim(F.regexp_replace(canonical, r"[ \n]+", " "))


def digest(canonical: Column) -> Column:
    return F.sha2(canonical.cast("binary"), 256)


def known_digests(spark: SparkSession, known=KNOWN) -> DataFrame:
    """(digest, license_id, length) of the known texts, one row per digest."""
    if len(known) > MAX_KNOWN:
        raise ValueError(f"more than {MAX_KNOWN} known texts")
    df = spark.createDataFrame(known, "license_id string, text string")
    body = one_line(canonical_lines(F.col("text")))
    return (
        df.select(digest(body).alias("known_digest"), "license_id", F.length(body).alias("known_length"))
        .filter("known_length > 0")
        .groupBy("known_digest")
        .agg(F.min("license_id").alias("license_id"), F.max("known_length").alias("known_length"))
    )


def scan(docs: DataFrame, known: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text_digest, license_id, notices): the licence that the entire
    text is, and the licences that any of its lines is, joined by ','."""
    canon = docs.select(F.col(doc_id).alias("doc_id"), canonical_lines(F.col(text)).alias("canon"))
    whole = canon.select("doc_id", digest(one_line(F.col("canon"))).alias("text_digest"))
    longest = known.agg(F.max("known_length")).first()[0] or 0
    lines = (
        canon.select("doc_id", digest(one_line(F.col("canon"))).alias("text_digest"), F.explode(F.split("canon", "\n")).alias("line"))
        .withColumn("line", one_line(F.col("line")))
        .filter((F.length("line") > 0) & (F.length("line") <= longest))
        .select("doc_id", "text_digest", digest(F.col("line")).alias("known_digest"))
    )
    notices = (
        lines.join(F.broadcast(known), "known_digest")
        .groupBy(F.col("doc_id").alias("n_id"), F.col("text_digest").alias("n_digest"))
        .agg(F.array_join(F.array_sort(F.collect_set("license_id")), ",").alias("notices"))
    )
    notices = stage(notices, "license-notices")
    named = whole.join(F.broadcast(known), F.col("text_digest") == F.col("known_digest"), "left")
    return named.join(
        notices, F.col("doc_id").eqNullSafe(F.col("n_id")) & F.col("text_digest").eqNullSafe(F.col("n_digest")), "left"
    ).select("doc_id", "text_digest", "license_id", F.coalesce("notices", F.lit("")).alias("notices"))


def op9_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence of every whole document, and of the notices among its lines."""
    return scan(table(spark, sf_dir, "documents"), known_digests(spark))


def _sql_canonical(x: str) -> str:
    t = f"translate({x}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    t = f"regexp_replace({t}, '(^|\\n)[ \\t]*(copyright|\\(c\\)|©|all rights reserved)[^\\n]*', chr(10), 'g')"
    t = f"regexp_replace({t}, '[\\x00-\\x09\\x0B-\\x2F\\x3A-\\x60\\x7B-\\x7F]+', ' ', 'g')"
    for old, new in SPELLINGS:
        t = f"replace({t}, '{old}', '{new}')"
    return t


def scan_sql() -> str:
    values = ", ".join("('{}', '{}')".format(i, t.replace("'", "''")) for i, t in KNOWN)
    flat = "trim(regexp_replace({}, '[ \\n]+', ' ', 'g'), ' ')"
    return f"""
WITH listed(license_id, text) AS (VALUES {values}),
known AS (
  SELECT sha256(body) AS digest, min(license_id) AS license_id
  FROM (SELECT license_id, {flat.format(_sql_canonical("text"))} AS body FROM listed)
  WHERE body <> '' GROUP BY 1),
canon AS (SELECT doc_id, {_sql_canonical("text")} AS canon FROM documents),
whole AS (SELECT doc_id, canon, sha256({flat.format("canon")}) AS text_digest FROM canon),
lines AS (SELECT doc_id, text_digest, {flat.format("line")} AS line
          FROM (SELECT doc_id, text_digest, unnest(string_split(canon, chr(10))) AS line FROM whole)),
notices AS (
  SELECT doc_id, text_digest, string_agg(DISTINCT license_id, ',' ORDER BY license_id) AS notices
  FROM lines JOIN known ON sha256(line) = digest GROUP BY 1, 2)
SELECT w.doc_id, w.text_digest, k.license_id, coalesce(n.notices, '') AS notices
FROM whole w LEFT JOIN known k ON w.text_digest = k.digest
LEFT JOIN notices n ON w.doc_id IS NOT DISTINCT FROM n.doc_id
  AND w.text_digest IS NOT DISTINCT FROM n.text_digest"""


QUERIES = {"op9_license": op9_license}
SQL = {"op9_license": scan_sql()}
