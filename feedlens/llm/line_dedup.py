"""Line dedup by distinct-site spread.

A HyperLogLog sketch of the sites is kept for each line hash and merged by
aggregation, so no task gathers the rows of a frequent line.  Lines whose
estimate is clear of the threshold are decided by it; lines near the threshold
get an exact distinct count.  Lines that stand on at least ``min_sites`` sites
are boilerplate and are removed from every document that has a line of its own; a
document of nothing but boilerplate stays whole for near-duplicate detection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlens.llm.frames import numbered

MIN_SITES = 10
#: Of the contract of op6_line_dedup only.
MIN_CHARS = 20
MAX_SHARE = 0.5
#: Relative standard deviation of a sketch (128 registers).
SKETCH_RSD = 0.1
#: Estimates within this factor of the threshold are counted exactly.
NEAR = 2.0


def _key(line: Column) -> Column:
    return F.xxhash64(F.trim(line))


def _filled(line: Column) -> Column:
    return F.rlike(line, F.lit(r"[^\s\p{Z}]"))


def _judged(line: Column, min_chars: int | None) -> Column:
    return _filled(line) if min_chars is None else F.length(F.trim(line)) >= min_chars


def _lines(docs: DataFrame, text: str, min_chars: int | None, *more: Column) -> DataFrame:
    lines = docs.select(*more, F.explode(F.split(F.col(text), "\n")).alias("__line"))
    lines = lines.where(_judged(F.col("__line"), min_chars))
    return lines.select(*[c for c in lines.columns if c != "__line"], _key(F.col("__line")).alias("__key"))


def boilerplate(docs: DataFrame, text: str = "text", site: str = "source", min_sites: int = MIN_SITES, min_chars: int | None = None) -> DataFrame:
    """Hashes (``__key``) of the lines that stand on at least ``min_sites`` sites.

    Every line that is not blank counts or, with ``min_chars``, every line of so
    many characters without outer spaces; a null site is none."""
    lines = _lines(docs, text, min_chars, F.col(site).alias("__site")).where(F.col("__site").isNotNull())
    spread = lines.groupBy("__key").agg(
        F.approx_count_distinct("__site", SKETCH_RSD).alias("__sites"), F.min("__site").alias("__low"), F.max("__site").alias("__high")
    )
    if min_sites > 1:
        spread = spread.where("__low < __high")
    spread = spread.select("__key", "__sites").where(F.col("__sites") >= min_sites / NEAR)
    clear = spread.where(F.col("__sites") > min_sites * NEAR).select("__key")
    near = spread.where(F.col("__sites") <= min_sites * NEAR).select("__key")
    # Distinct first (map-side for a frequent line), so the join meets a line's sites, not its rows.
    exact = lines.distinct().join(near, "__key", "left_semi").groupBy("__key").agg(F.count("*").alias("__sites"))
    return clear.unionByName(exact.where(F.col("__sites") >= min_sites).select("__key"))


def remove_boilerplate(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    site: str = "source",
    min_sites: int = MIN_SITES,
    min_chars: int | None = None,
    max_share: float | None = None,
    counts: tuple[str, str] = ("n_lines", "n_removed"),
) -> DataFrame:
    """The documents with boilerplate lines taken out of ``text``, and the new
    columns ``n_lines`` and ``n_removed``.

    Lines end at line feeds and are compared without outer spaces.  A document
    whose lines are all boilerplate or blank is left as it is; with ``max_share``
    instead one whose boilerplate lines hold more than that share of the
    characters of its lines.  A null text stays null with no lines, an empty one
    has one empty line.  Rows that repeat a doc_id are judged each by its own
    text; a null doc_id is an id like any other.  Other columns pass unchanged,
    except that columns named like the two new ones are replaced."""
    found = boilerplate(docs, text, site, min_sites, min_chars)
    hits = (
        _lines(docs, text, min_chars, F.col(doc_id).alias("__doc"), F.xxhash64(text).alias("__text"))
        .join(found, "__key", "left_semi")
        .groupBy("__doc", "__text")
        .agg(F.collect_set("__key").alias("__drop"))
    )
    base, names = numbered(docs)
    # The text is part of the key: rows without an id, or that share one, are no single group.
    joined = base.join(hits, base[names[doc_id]].eqNullSafe(hits["__doc"]) & (F.xxhash64(base[names[text]]) == hits["__text"]), "left")
    lines = F.split(F.col(names[text]), "\n")
    size = lambda part: F.aggregate(part, F.lit(0), lambda n, x: n + F.length(x))
    kept = F.filter(lines, lambda x: ~(_judged(x, min_chars) & F.array_contains("__drop", _key(x))))
    joined = joined.withColumn("__kept", F.when(F.col("__drop").isNull(), lines).otherwise(kept))
    most = ~F.exists("__kept", _filled) if max_share is None else size(lines) - size(F.col("__kept")) > max_share * size(lines)
    whole = F.col("__drop").isNull() | most
    joined = joined.withColumn("__kept", F.when(whole, lines).otherwise(F.col("__kept")))
    there = F.col(names[text]).isNotNull()
    n_lines = F.when(there, F.size(lines)).otherwise(0).cast("long").alias(counts[0])
    n_removed = F.when(there, F.size(lines) - F.size("__kept")).otherwise(0).cast("long").alias(counts[1])
    out = [F.array_join("__kept", "\n").alias(text) if c == text else F.col(n).alias(c) for c, n in names.items() if c not in counts]
    return joined.select(*out, n_lines, n_removed)


ORACLE = f"""
WITH lines AS (
  SELECT doc_id, source, pos, line FROM (
    SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
           unnest(range(len(string_split(text, chr(10))))) AS pos
    FROM documents WHERE text IS NOT NULL)
), spread AS (
  SELECT trim(line, ' ') AS line FROM lines WHERE regexp_matches(line, '[^\\x09-\\x0D\\x20\\p{{Z}}]')
  GROUP BY 1 HAVING count(DISTINCT source) >= {MIN_SITES}
), judged AS (
  SELECT l.doc_id, l.pos, l.line, s.line IS NOT NULL AS hit,
    s.line IS NULL AND regexp_matches(l.line, '[^\\x09-\\x0D\\x20\\p{{Z}}]') AS own
  FROM lines l LEFT JOIN spread s ON trim(l.line, ' ') = s.line
), counted AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE hit) AS n_hits,
         NOT bool_or(own) AS whole
  FROM judged GROUP BY doc_id
), kept AS (
  SELECT j.doc_id, string_agg(j.line, chr(10) ORDER BY j.pos) FILTER (WHERE c.whole OR NOT j.hit) AS text
  FROM judged j JOIN counted c ON c.doc_id = j.doc_id GROUP BY j.doc_id
)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text,
       coalesce(c.n_lines, 0) AS n_lines,
       coalesce(CASE WHEN c.whole THEN 0 ELSE c.n_hits END, 0) AS n_removed
FROM documents d LEFT JOIN counted c ON c.doc_id = d.doc_id LEFT JOIN kept k ON k.doc_id = d.doc_id
"""
