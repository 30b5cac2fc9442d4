"""Mixing sources to target weights, with DataFrame functions only.

Every document gets a random key, the md5 of its id and its text's md5. Within each source
documents are range-sorted by that key: its leading hex digits are the range a document is
in, so the ranges are even without sampling, and a source with a third of all rows, or many
rows with one id or none, are spread over all of them. Running totals of sizes are taken
inside each range and over the ranges' sums, and each source is cut at its exact budget:
whole epochs first, then the documents whose running total lies within the rest. The
document on the cut is taken in part.

Targets: sources by code point, null last, weigh 1, 2, 3 and so on again, and share all
sizes. A target stops at MOST times its source's size, and what is cut goes to the others
by weight. Sorted by size over weight, the sources that stop are a prefix: source s stops
if lambda * w_s > MOST * size_s, where lambda is what is left after the stopped ones
divided by the weight of the rest.

Defined cases: a null or empty text has size 0 and takes nothing; null is a source of its
own; a source of size 0 has target 0; rows alike in every way share the same places in
either order, so the rows returned are the same. A null id counts as the empty string in
the key. Only rows with one id and one text share a key, and so a range. A very long text
is one row of its size. Columns other than id, source and text are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexloom.llm import shared as S

#: A target stops at so many times the size of its source.
MOST = 3
#: Documents in one range of one source, about; hex digits of the key follow from it.
PER_RANGE = 20_000
LEAST_DIGITS = 2


def sizes(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", row: str | None = None) -> DataFrame:
    """(row, doc_id, source, size, rnd): the narrow rows everything else works on, written once."""
    rows = S.named(docs, doc_id=key, text=text, source=source, **({} if row is None else {"row": row}))
    number = F.lit(0) if row is None else F.col("row")
    written = F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"))
    rnd = F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), written).cast("binary"))
    return rows.select(number.cast("long").alias("row"), F.col("doc_id").cast("long"), F.col("source").cast("string"), S.word_count(F.col("text").cast("string")).alias("size"), rnd.alias("rnd"))


def running(df: DataFrame, order: list[Column], value: str) -> DataFrame:
    """Adds ``before`` and ``total`` of a value over all rows of a table of sources, and its rank ``nr`` from 0.

    For rows that are aggregates already. They are numbered by range partitions, so no task
    holds more than a partition of them and one row for each partition.
    """
    spark = df.sparkSession
    parts = S.durable(df.repartitionByRange(S.shuffle_width(spark), *order).withColumn("pt", F.spark_partition_id()))
    sums = parts.groupBy("pt").agg(F.sum(value).alias("s"), F.count("*").alias("c"))
    # a row for each partition: as many as spark.sql.shuffle.partitions at most
    before = Window.orderBy("pt").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("pt", F.coalesce(F.sum("s").over(before), F.lit(0)).alias("s"), F.coalesce(F.sum("c").over(before), F.lit(0)).alias("c"))
    inside = Window.partitionBy("pt").orderBy(*order)
    rows = parts.withColumn("in_pt", F.coalesce(F.sum(value).over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).withColumn("nr", F.row_number().over(inside) - 1)
    return rows.join(F.broadcast(sums), "pt").withColumn("before", F.col("s") + F.col("in_pt")).withColumn("nr", F.col("nr") + F.col("c")).drop("pt", "s", "c", "in_pt")


def targets(narrow: DataFrame) -> DataFrame:
    """(source, source_size, target, n_rows, sizes_before) of every source, from its documents' sizes; sizes_before: of the sources before it."""
    by_source = narrow.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_rows"))
    numbered = running(by_source, [F.col("source").asc_nulls_last()], "source_size")
    weighed = numbered.select("source", "source_size", "n_rows", F.col("before").alias("sizes_before"), (F.col("nr") % 3 + 1).alias("weight"))
    # the ratio at which a source stops is MOST * size / weight; times 6 it is a whole number for weights 1, 2 and 3
    ratio = F.when(F.col("weight") == 1, 6 * MOST).when(F.col("weight") == 2, 3 * MOST).otherwise(2 * MOST) * F.col("source_size")
    stops = weighed.withColumn("ratio", ratio)
    stops = running(stops, [F.col("ratio"), F.col("source").asc_nulls_last()], "source_size").withColumnRenamed("before", "size_before")
    stops = running(stops.drop("nr"), [F.col("ratio"), F.col("source").asc_nulls_last()], "weight").withColumnRenamed("before", "weight_before")
    stops = S.durable(stops)
    sizes_, weights = stops.agg(F.sum("source_size"), F.sum("weight")).first()
    rest = stops.withColumn("left", F.lit(sizes_ or 0) - MOST * F.col("size_before")).withColumn("open", F.lit(weights or 0) - F.col("weight_before"))
    # the first source that doesn't stop fixes lambda
    wide = lambda c: F.col(c).cast("decimal(19,0)")  # noqa: E731  the products pass 64 bits
    going = wide("left") * wide("weight") <= wide("source_size") * wide("open") * MOST
    level = rest.filter(going).agg(F.min(F.struct("nr", "left", "open")).alias("at")).first()["at"]
    stopped = (MOST * F.col("source_size")).cast("double")
    # there is always a first one: not all sources can stop at several times all there is
    target = F.when(F.col("nr") >= level["nr"], F.lit(level["left"]).cast("double") * F.col("weight") / F.lit(level["open"])).otherwise(stopped) if level else stopped
    return rest.select("source", "source_size", target.alias("target"), "n_rows", "sizes_before")


def mix_sources(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", row: str | None = None) -> DataFrame:
    """(row, doc_id, source, size, source_size, target, taken, full, part) of every document; row: a number to carry along.

    taken = full * size + part: the epochs that take the whole document, and the words that
    the last, broken epoch takes of it.
    """
    narrow = S.durable(sizes(docs, key, text, source, row))
    # a short table of sources: joined by broadcast if Spark finds it small, else by a join that splits hot sources
    goals = S.durable(targets(narrow))
    most = goals.agg(F.max("n_rows")).first()[0] or 0
    digits = LEAST_DIGITS
    while most > PER_RANGE * 16**digits:
        digits += 1
    placed = narrow.withColumn("range", F.substring("rnd", 1, digits))
    sums = placed.groupBy("source", "range").agg(F.sum("size").alias("range_size"))
    # over all sources in order, less what lies before the source: no source's ranges are in one task
    sums = running(sums, [F.col("source").asc_nulls_last(), F.col("range")], "range_size")
    sums = sums.join(goals, sums["source"].eqNullSafe(goals["source"])).select(sums["source"], "range", (F.col("before") - F.col("sizes_before")).alias("of_ranges"), "source_size", "target")
    inside = Window.partitionBy("source", "range").orderBy("rnd", "doc_id", "size", "row").rowsBetween(Window.unboundedPreceding, -1)
    rows = placed.withColumn("in_range", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    same = rows["source"].eqNullSafe(sums["source"]) & (rows["range"] == sums["range"])
    rows = rows.join(sums, same).select("row", "doc_id", rows["source"], "size", "source_size", "target", (F.col("of_ranges") + F.col("in_range")).alias("before"))
    budget = F.floor("target")
    full = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long")
    part = F.greatest(F.lit(0), F.least(F.col("size"), budget - full * F.col("source_size") - F.col("before"))).cast("long")
    rows = rows.withColumn("full", full).withColumn("part", part)
    return rows.withColumn("taken", F.col("full") * F.col("size") + F.col("part")).drop("before")


#: The places right after a word, but for the last where no white space follows: between them lie the words, each with the white space before it.
AFTER_WORD = r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])"


def take(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", length: str = "n_chars") -> DataFrame:
    """The mixture: each document once for each epoch that takes it whole, and the one on a source's cut up to the last word taken.

    Rows are numbered and written down first, so ids may be missing or repeat. A column
    named as ``length`` follows a cut text.
    """
    names = [f"c{i}" for i in range(len(docs.columns))]
    numbered = S.stored(docs.toDF(*names).withColumn("row", F.monotonically_increasing_id()), "mixing-rows")
    at = {n: names[S.place(docs.columns, c)] for c, n in ((key, "doc_id"), (text, "text"), (source, "source"))}
    goals = mix_sources(numbered, at["doc_id"], at["text"], at["source"], "row").filter(F.col("taken") > 0).select("row", "size", "full", "part")
    copies = numbered.join(goals, "row").withColumn("copy", F.explode(F.sequence(F.lit(1), (F.col("full") + (F.col("part") > 0).cast("long")).cast("int"))))
    words = F.col(at["text"])
    cut = F.array_join(F.slice(F.split(words, AFTER_WORD), 1, F.col("part").cast("int")), "")
    now = F.when((F.col("copy") <= F.col("full")) | (F.col("part") == F.col("size")), words).otherwise(cut)
    follows = names[docs.columns.index(length)] if length in docs.columns else None
    made = copies.withColumn("now", now)
    return made.select(*[(F.col("now") if c == at["text"] else F.length("now").cast(field.dataType) if c == follows else F.col(c)).alias(field.name) for c, field in zip(names, docs.schema)])


SQL = r"""
WITH d AS (SELECT doc_id, source, CAST(CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END AS BIGINT) AS size,
                  md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))) AS rnd FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM s),
c AS (SELECT *, CAST(18 * source_size / weight AS BIGINT) AS ratio FROM w),
r AS (SELECT *, row_number() OVER (ORDER BY ratio, source NULLS LAST) AS nr,
        sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS remaining,
        sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS open_weight FROM c),
l AS (SELECT nr AS from_nr, remaining, open_weight FROM r WHERE remaining * weight <= 3 * source_size * open_weight ORDER BY nr LIMIT 1),
t AS (SELECT r.source, r.source_size, CASE WHEN r.nr >= l.from_nr THEN CAST(l.remaining AS DOUBLE) * r.weight / l.open_weight ELSE CAST(3 * r.source_size AS DOUBLE) END AS target FROM r, l),
p AS (SELECT d.*, coalesce(sum(size) OVER (PARTITION BY source ORDER BY rnd, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM d),
j AS (SELECT p.doc_id, p.size, t.source_size, t.target, p.before,
        CASE WHEN t.source_size > 0 THEN CAST(floor(floor(t.target) / t.source_size) AS BIGINT) ELSE 0 END AS epochs
      FROM p JOIN t ON p.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(epochs * size + greatest(0, least(size, CAST(floor(target) AS BIGINT) - epochs * source_size - before)) AS BIGINT) AS taken FROM j
"""
