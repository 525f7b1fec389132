"""Removal of repeated passages by overlapping windows of consecutive lines.

Every three consecutive lines of a text are a window, known by the MD5 of its lines. Of
all occurrences of a window the first stays: that of the least id, then the least row
key, then the first line. The later ones cover their lines; covered positions are
merged and removed. Windows are judged on the input, not on what is left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabflow.llm.common import row_key, spare_name


def _windows(lines: Column, size: int) -> Column:
    """(position, hash) of every window that has something else than white space."""
    start = F.sequence(F.lit(0), F.size(lines) - size)
    told = lambda line: line.rlike("[^ \t\r\n]")
    some = F.filter(start, lambda i: F.exists(F.slice(lines, i + 1, size), told))
    every = F.transform(some, lambda i: F.struct(
        i.alias("at"), F.unhex(F.md5(F.concat_ws("\n", F.slice(lines, i + 1, size)))).alias("hash")))
    return F.when(F.size(lines) >= size, every).otherwise(F.array().cast("array<struct<at:int,hash:binary>>"))


def drop_repeated_lines(docs: DataFrame, window: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with repeated windows gone from the text, and the columns n_lines, n_removed.

    Columns of these names, in any case, are replaced, all others stay. A text with fewer lines than a
    window, null or empty has no window and stays as it is, as do windows of nothing but white
    space. Null ids come before all others. Rows that agree in id and text count as one
    document and are cut alike; the same text under another id loses its windows.
    One row is shuffled per window, its hash and place; a window on a third of all lines
    is reduced to its first place in every task, and the join that finds its later places
    is one that AQE splits.
    """
    key, lines, gone = (spare_name(docs, base) for base in ("_key", "_lines", "_gone"))
    lead = docs.select(F.col(id_col).alias("id"), row_key(id_col, text_col).alias("k"),
                       F.split(F.col(text_col), "\n").alias("lines")).where(F.size("lines") >= window)
    places = lead.select("id", "k", F.explode(_windows(F.col("lines"), window)).alias("w"))
    places = places.select("w.hash", F.struct("id", "k", "w.at").alias("place"))
    first = places.groupBy("hash").agg(F.min("place").alias("first"), F.count("*").alias("n")).where("n > 1")
    later = places.join(first.select("hash", "first"), "hash").where(F.col("place") != F.col("first"))
    covered = later.groupBy(F.col("place.k").alias(key)).agg(F.collect_set("place.at").alias("starts"))
    spread = F.array_distinct(F.flatten(F.transform("starts", lambda at: F.sequence(at, at + (window - 1)))))
    marked = docs.withColumn(key, row_key(id_col, text_col)).join(covered.select(key, spread.alias(gone)), key, "left")
    marked = marked.withColumn(lines, F.split(F.col(text_col), "\n"))
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(gone))
    kept = F.array_join(F.transform(stay, lambda i: F.get(F.col(lines), i)), "\n")
    cut = F.col(gone).isNotNull()
    columns = [F.when(cut, kept).otherwise(F.col(text_col)).alias(c) if c == text_col else F.col(c)
               for c in docs.columns if c.lower() not in ("n_lines", "n_removed")]
    counts = [F.coalesce(F.when(F.col(text_col).isNull(), 0).otherwise(F.size(lines)), F.lit(0)).alias("n_lines"),
              F.coalesce(F.when(cut, F.size(gone)), F.lit(0)).alias("n_removed")]
    return marked.select(*columns, *counts)


# Row keys break ties only between rows of one id, so the SQL orders by id and line.
LINE_SQL = """
WITH lines AS (
    SELECT doc_id, string_split(text, chr(10)) AS l FROM documents
), windows AS (
    SELECT doc_id, i AS pos, l[i] || chr(10) || l[i + 1] || chr(10) || l[i + 2] AS w
    FROM (SELECT doc_id, l, unnest(range(1, len(l) - 1)) AS i FROM lines WHERE len(l) >= 3)
), ranked AS (
    SELECT doc_id, pos, row_number() OVER (PARTITION BY w ORDER BY doc_id, pos) AS n
    FROM windows WHERE trim(translate(w, chr(9) || chr(10) || chr(13), '   ')) <> ''
), gone AS (
    SELECT DISTINCT doc_id, pos + d AS pos FROM ranked, (VALUES (0), (1), (2)) AS t(d) WHERE n > 1
), kept AS (
    SELECT a.doc_id, string_agg(a.line, chr(10) ORDER BY a.pos) AS text
    FROM (SELECT doc_id, unnest(l) AS line, unnest(range(1, len(l) + 1)) AS pos FROM lines) a
    ANTI JOIN gone g ON a.doc_id = g.doc_id AND a.pos = g.pos
    GROUP BY a.doc_id
), lost AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT l.doc_id, CAST(len(l.l) AS INTEGER) AS n_lines, CAST(coalesce(g.n, 0) AS INTEGER) AS n_removed,
       sha256(coalesce(k.text, '')) AS kept_sha256
FROM lines l LEFT JOIN kept k USING (doc_id) LEFT JOIN lost g USING (doc_id)
"""
