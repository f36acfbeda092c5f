"""Mixing sources to target weights (native: DataFrame and SQL functions only).

Weighted fair queueing: the documents of a source stand in a shuffled queue (a
hash of the id), twice over if the source may be repeated. An entry's virtual
finish time is the words its source has sent up to and with it, divided by the
source's weight. All entries are range-sorted by that time and the mix is cut
where the running total reaches the budget. A source that runs out sends no
more, so its share goes to the others by weight, as the targets say.

Times are whole numbers (words times the weights' common multiple over the
weight), so every run and engine finds the same order. Words before an entry
are counted in two steps, so that no source is one task: a source's hash range
is cut into buckets of about ``BUCKET_ROWS`` rows, whose totals are added up,
and rows are counted within their bucket. The cut is found from the totals of
the sorted partitions, then within the one partition that it falls in.
"""

from __future__ import annotations

from math import lcm

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut, join_small, read_documents

#: Weights of the sources in code-point order, repeating.
WEIGHTS = (5, 2, 1)
#: The budget in halves of all words: 150 %.
BUDGET_HALVES = 3
#: How often a document may be taken.
PASSES = 2
#: Rows of a source that are counted in one group.
BUCKET_ROWS = 1024
#: Entries among which the cut is found in one task; more are sorted apart again.
LAST_ROWS = 100_000

_WORD, _BLANKS = r"[^\x20\x09-\x0D]++[\x20\x09-\x0D]*+", " \t\n\x0b\x0c\r"


def word_count(text: Column) -> Column:
    """Number of runs without blanks (0x20, 0x09-0x0D): every run and the
    blanks after it become one letter, so no list of words is built."""
    return F.coalesce(F.length(F.ltrim(F.regexp_replace(text, _WORD, "x"), F.lit(_BLANKS))), F.lit(0)).cast("long")


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, source, size (words), key (60 bits of a hash of the id)."""
    doc_id = F.col(id_col).cast("long")
    return docs.select(doc_id.alias("doc_id"), F.col(source_col).cast("string").alias("source"), word_count(F.col(text_col)).alias("size"),
                       F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), 1, 15), 16, 10)
                       .cast("long").alias("key"))


def targets(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """One row a source: source, source_no (from 1), n_rows, source_size,
    total (words of all sources), pace (virtual time of a word) and target:
    the budget shared by weight, where none gets more than PASSES times its
    size and the excess goes to the others by weight."""
    every = lcm(*weights)
    per = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count_if(F.col("size") > 0).alias("n_rows"))
    of = "element_at(array({}), CAST((source_no - 1) % {} + 1 AS INT))"
    named = per.withColumn("source_no", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())).cast("long")).selectExpr(
        "*", of.format(",".join(f"{w}L" for w in weights), len(weights)) + " AS weight",
        of.format(",".join(f"{every // w}L" for w in weights), len(weights)) + " AS pace", f"{PASSES} * source_size AS most",
        "sum(source_size) OVER () AS total")
    # the sources that run out first come first; one runs out if, with those
    # before it run out, an even level of all others still covers it
    by = "(ORDER BY most * pace, source_no ROWS BETWEEN {} AND {})"
    level = named.selectExpr("*", f"(total * {BUDGET_HALVES} / 2.0D - coalesce(sum(most) OVER {by.format('UNBOUNDED PRECEDING', '1 PRECEDING')}, 0))"
                             f" / sum(weight) OVER {by.format('CURRENT ROW', 'UNBOUNDED FOLLOWING')} AS level")
    out = level.selectExpr("*", "level * weight >= most AS runs_out")
    return out.selectExpr("source", "source_no", "n_rows", "source_size", "total", "pace",
                          "CASE WHEN runs_out THEN CAST(most AS DOUBLE) ELSE weight *"
                          " min_by(level, named_struct('a', runs_out, 'b', most * pace, 'c', source_no)) OVER () END AS target")


def queued(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """The rows with words, and sent: words of the source up to and with the
    row in its shuffled queue. Rows alike in id and size follow each other."""
    placed = join_small(rows.filter("size > 0"), sources.select("source", "source_no", "n_rows", "pace", "source_size"), "source").selectExpr(
        "doc_id", "source_no", "pace", "source_size", "size", "key",
        # top bits of the key times the number of buckets: keeps the order
        f"((key >> 30) * (n_rows DIV {BUCKET_ROWS} + 1)) >> 30 AS bucket")
    before = placed.groupBy("source_no", "bucket").agg(F.sum("size").alias("words")).selectExpr(
        "source_no", "bucket", "sum(words) OVER (PARTITION BY source_no ORDER BY bucket) - words AS before")
    inside = placed.selectExpr("*", "sum(size) OVER (PARTITION BY source_no, bucket ORDER BY key, doc_id, size"
                                    " ROWS UNBOUNDED PRECEDING) AS inside")
    return inside.join(before, ["source_no", "bucket"]).selectExpr(
        "doc_id", "source_no", "pace", "source_size", "size", "before + inside AS sent")


def entries(queue: DataFrame) -> DataFrame:
    """Every row of the queue PASSES times, with its virtual finish time. As
    rows have words, times of a source rise, and (finish, source_no) is the
    place of one entry alone."""
    return queue.withColumn("pass", F.explode(F.array(*[F.lit(k) for k in range(PASSES)]))).selectExpr(
        "doc_id", "source_no", "size", "pass", "(pass * source_size + sent) * pace AS finish")


def last_entry(items: DataFrame, budget: int) -> tuple[int, int] | None:
    """(finish, source_no) of the last entry that the budget holds, or None."""
    place = ["finish", "source_no"]
    # a number of its own: Spark must not merge partitions, or none gets smaller
    n_parts = max(2, int(items.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    found = None
    while True:
        part = cut(items.select(*place, "size").repartitionByRange(n_parts, *place).sortWithinPartitions(*place)
                   .withColumn("part", F.spark_partition_id()))
        # one row a partition, in order
        totals = part.groupBy("part").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("n"),
                                          F.max(F.struct(*place)).alias("last")).withColumn(
            "upto", F.sum("words").over(Window.orderBy("part")))
        over = totals.filter(F.col("upto") > budget).orderBy("part").first()
        whole = totals.filter(F.col("upto") <= budget).orderBy(F.desc("part")).first()
        if whole is not None:
            found, budget = tuple(whole["last"]), budget - whole["upto"]
        if over is None:
            return found
        inner = part.filter(F.col("part") == over["part"])
        if over["n"] <= LAST_ROWS:
            end = inner.withColumn("upto", F.sum("size").over(Window.orderBy(*place).rowsBetween(Window.unboundedPreceding, 0))).filter(
                F.col("upto") <= budget).agg(F.max(F.struct(*place)).alias("last")).first()["last"]
            return tuple(end) if end is not None else found
        items = inner


def _planned(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> tuple[DataFrame, DataFrame, DataFrame, tuple[int, int]]:
    """(rows, sources, queue, last entry that the budget holds)."""
    rows = cut(sized(docs, id_col, text_col, source_col))
    sources = cut(targets(rows))
    total = sources.agg(F.max("total")).first()[0] or 0
    queue = cut(queued(rows, sources))
    return rows, sources, queue, last_entry(entries(queue), total * BUDGET_HALVES // 2) or (-1, -1)


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, source, size (words; null text has none), source_size, target
    (its source's), taken (words that the mix takes, repeats counted) of
    every row.

    Documents are taken whole, so a source's taken words are within a document
    or so of its target. Rows without words take nothing. A null source is one
    source, the last. A null id is shuffled as empty text; rows that share an
    id stand next to each other and count each. An empty table gives no rows."""
    rows, sources, queue, (finish, source_no) = _planned(docs, id_col, text_col, source_col)
    # the pass k of a row finishes k rounds of its source after the first
    passes = " + ".join(f"CAST(struct(({k} * source_size + sent) * pace, source_no) <= struct({finish}L, {source_no}L) AS LONG)"
                        for k in range(PASSES))
    taken = queue.selectExpr("doc_id", "source_no", "size", f"size * ({passes}) AS taken")
    idle = join_small(rows.filter("size = 0"), sources.select("source", "source_no"), "source").selectExpr(
        "doc_id", "source_no", "size", "0L AS taken")
    about = sources.select("source_no", "source", "source_size", "target")
    return join_small(taken.unionByName(idle), about, "source_no").select("doc_id", "source", "size", "source_size", "target", "taken")


def sequence(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix itself in its order: doc_id, source, pass (0 is the first),
    size, finish of every entry taken. Edge cases as in ``mix``."""
    _, sources, queue, (finish, source_no) = _planned(docs, id_col, text_col, source_col)
    kept = entries(queue).filter(f"struct(finish, source_no) <= struct({finish}L, {source_no}L)")
    return (join_small(kept, sources.select("source_no", "source"), "source_no").repartitionByRange("finish", "source_no")
            .sortWithinPartitions("finish", "source_no").select("doc_id", "source", "pass", "size", "finish"))


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read_documents(spark, sf_dir))


ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS key
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS source_no
  FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][((source_no - 1) % 3 + 1)::INT] AS weight, 2 * source_size AS most FROM s),
-- share out, cap, and share the excess out again, until no source is above its cap
share AS (
  SELECT 0 AS round, source_no, weight, most, false AS capped, 0::DOUBLE AS target FROM w
  UNION ALL
  SELECT round + 1, source_no, weight, most, capped OR t >= most, CASE WHEN capped OR t >= most THEN most ELSE t END
  FROM (SELECT *, weight * (((SELECT sum(source_size) FROM s) * 3 / 2.0::DOUBLE
                             - coalesce(sum(CASE WHEN capped THEN most END) OVER (), 0))
                            / sum(CASE WHEN capped THEN 0 ELSE weight END) OVER ()) AS t,
               count(*) FILTER (NOT capped) OVER () AS open_, (SELECT count(*) FROM s) AS n FROM share) q
  WHERE round <= n AND (open_ > 0)),
goal AS (SELECT source_no, arg_max(target, round) AS target FROM share GROUP BY source_no),
queue AS (
  SELECT d.doc_id, w.source_no, d.size,
         sum(d.size) OVER (PARTITION BY w.source_no ORDER BY d.key, d.doc_id NULLS FIRST, d.size ROWS UNBOUNDED PRECEDING) AS sent,
         w.source_size, 10 // w.weight AS pace
  FROM d JOIN w ON d.source IS NOT DISTINCT FROM w.source WHERE d.size > 0),
entry AS (
  SELECT doc_id, source_no, size, (p * source_size + sent) * pace AS finish FROM queue, (VALUES (0), (1)) AS v(p)),
line AS (SELECT *, sum(size) OVER (ORDER BY finish, source_no ROWS UNBOUNDED PRECEDING) AS upto FROM entry),
took AS (
  SELECT doc_id, source_no, size, sum(size) AS words, count(*) AS n FROM line
  WHERE 2 * upto <= 3 * (SELECT sum(source_size) FROM s) GROUP BY ALL)
SELECT d.doc_id, d.source, d.size, w.source_size, goal.target::DOUBLE AS target, coalesce(took.words, 0)::BIGINT AS taken
FROM d JOIN w ON d.source IS NOT DISTINCT FROM w.source JOIN goal USING (source_no)
LEFT JOIN took ON took.doc_id IS NOT DISTINCT FROM d.doc_id AND took.source_no = w.source_no AND took.size = d.size
"""
