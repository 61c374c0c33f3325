"""Removal of lines that many sites carry.

A line is what stands between line feeds; lines count as equal if they are after
cutting spaces at either end, and blank ones are never removed. The spread of a
line is the number of distinct sites whose texts have it:

1. each line's sites go into a HyperLogLog sketch, sketches merge by aggregation
   over the line's hash (128 bits), partly before the shuffle;
2. lines whose estimate is further from the threshold than :data:`BAND` standard
   errors are settled by it; the others get an exact distinct count;
3. lines of ``min_sites`` sites and more go from all texts.

The hashes of these lines are sent to the tasks while there are at most
:data:`SENT` of them; beyond that the lines are joined and texts put together again.

A null text stays null and has no lines; an empty one has one blank line. Null
sites count as no site. A text all of whose lines go becomes the empty text; the
row stays. Repeated rows are repeated in the result. Long texts need no more than
themselves in memory. Empty tables give empty ones; other columns pass unchanged,
whatever their names: where a column ``n_lines`` or ``n_removed`` is there already,
the new one's name starts with an underscore more.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rostrum.llm.runtime import bounded_batches, chunks, materialise, spare_names

MIN_SITES = 10
#: Sketch size (log2 of registers) and the standard errors around the threshold within which lines are counted exactly.
LOG_K, BAND = 10, 4
#: Most line hashes that are sent to every task: 16 bytes each.
SENT = 500_000


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _key(line: Column) -> Column:
    return F.unhex(F.md5(line))


def spread(docs: DataFrame, min_sites: int = MIN_SITES, *, text_col: str = "text", site_col: str = "source") -> DataFrame:
    """``key`` of every line that at least ``min_sites`` sites carry."""
    lines = F.array_distinct(F.transform(_lines(F.col(text_col)), lambda x: F.trim(x)))
    seen = docs.select(F.col(site_col).cast("string").alias("site"), F.explode(lines).alias("line")).where("line <> '' and site is not null")
    seen = seen.select(_key(F.col("line")).alias("key"), "site")
    estimated = seen.groupBy("key").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(LOG_K))).alias("n"))
    slack = BAND * 1.04 / (1 << LOG_K) ** 0.5
    over = estimated.where(F.col("n") > min_sites * (1 + slack) + 0.5).select("key")
    near = estimated.where(F.col("n").between(min_sites * (1 - slack) - 0.5, min_sites * (1 + slack) + 0.5)).select("key")
    #: distinct first, partly before the shuffle: a line near the threshold then has few rows, however often it stands in texts
    exact = seen.distinct().join(near, "key", "left_semi").groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") >= min_sites).select("key")
    return over.union(exact)


def remove_lines(docs: DataFrame, keys: DataFrame, *, text_col: str = "text", counts: bool = True) -> DataFrame:
    """``docs`` without the lines of ``keys``; with ``counts``, further columns ``n_lines`` and ``n_removed``."""
    keys = materialise(keys, "line-keys")
    names = spare_names(docs.columns, "n_lines", "n_removed") if counts else []
    schema = docs.select("*", *(F.lit(0).cast("long").alias(c) for c in names)).schema
    if keys.count() > SENT:
        return _remove_joined(docs, keys, text_col, names)
    gone = frozenset(bytes(r.key) for r in keys.collect())  # SENT rows at most
    position = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, position, 1 << 20):
            texts, n_lines, n_removed = [], [], []
            for text in b.column(position).to_pylist():
                lines = [] if text is None else text.split("\n")
                kept = [x for x in lines if not (y := x.strip(" ")) or hashlib.md5(y.encode()).digest() not in gone]
                texts.append(None if text is None else "\n".join(kept))
                n_lines.append(len(lines))
                n_removed.append(len(lines) - len(kept))
            columns = list(b.columns)
            columns[position] = pa.array(texts, pa.string())
            more = [pa.array(n_lines, pa.int64()), pa.array(n_removed, pa.int64())] if counts else []
            yield pa.RecordBatch.from_arrays([*columns, *more], schema.names)

    return docs.mapInArrow(run, schema)


def _remove_joined(docs: DataFrame, keys: DataFrame, text_col: str, names: list[str]) -> DataFrame:
    """The same by joins: no more than one text's lines come together in a task."""
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"), F.col(f"`{text_col}`").alias("text"))
    marked = whole.withColumn("row", F.md5(F.to_json("doc", {"ignoreNullFields": "false"})))
    lines = marked.select("row", F.posexplode(_lines(F.col("text"))).alias("at", "line")).distinct()
    kept = lines.withColumn("key", F.when(F.trim("line") != "", _key(F.trim("line")))).join(keys, "key", "left_anti")
    texts = kept.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("at", "line"))).alias("kept"))
    joined = marked.join(texts, "row", "left")
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(F.size(_lines(F.col("text")))).cast("long")
    left = F.coalesce(F.size("kept"), F.lit(0)).cast("long")
    new = F.when(F.col("text").isNotNull(), F.coalesce(F.array_join(F.transform("kept", lambda x: x["line"]), "\n"), F.lit("")))
    columns = [(new if c == text_col else F.col("doc").getField(c)).alias(c) for c in docs.columns]
    return joined.select(*columns, *(x.alias(c) for x, c in zip((n_lines, n_lines - left), names, strict=False)))


def dedup_lines(docs: DataFrame, min_sites: int = MIN_SITES, *, text_col: str = "text", site_col: str = "source", counts: bool = True) -> DataFrame:
    """``docs`` without lines of ``min_sites`` sites and more, with ``n_lines`` and ``n_removed`` (unless ``counts`` is false)."""
    bounded_batches(docs.sparkSession)
    return remove_lines(docs, spread(docs, min_sites, text_col=text_col, site_col=site_col), text_col=text_col, counts=counts)


#: The same over ``documents`` in SQL, as query op7 returns it.
SQL = f"""
WITH l AS (
  SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, unnest(range(1, 1 + len(string_split(text, chr(10))))) AS pos FROM documents
), wide AS (
  SELECT trim(line, ' ') AS k FROM l WHERE trim(line, ' ') <> '' GROUP BY 1 HAVING count(DISTINCT source) >= {MIN_SITES}
), kept AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE k IS NOT NULL) AS n_removed,
         coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE k IS NULL), '') AS cleaned
  FROM l LEFT JOIN wide ON trim(line, ' ') = k GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed,
       CASE WHEN d.text IS NOT NULL THEN sha256(coalesce(cleaned, '')) END AS cleaned_sha256
FROM documents d LEFT JOIN kept USING (doc_id)
"""
