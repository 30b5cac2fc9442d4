"""Gold cases: lists of provisions written by people, turned into node ids."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexloom.operators.dedup import unambiguous

# What such lists call certain laws, what lies outside the corpus, and what isn't current text.
LIST_NAMES = {
    "一般社団法": "一般社団法人及び一般財団法人に関する法律",
    "特定調停法": "特定債務等の調整の促進のための特定調停に関する法律",
    "災害減免法": "災害被害者に対する租税の減免、徴収猶予等に関する法律",
    "措置法": "租税特別措置法",
    "措置法施行令": "租税特別措置法施行令",
    "措置法施行規則": "租税特別措置法施行規則",
    "通則法": "国税通則法",
    "徴収法": "国税徴収法",
    "印紙法": "印紙税法",
}
OUTSIDE = r"通達|条約|協定|告示|Q&A|Q＆A|議定書|「|^(?:明治|大正|昭和|平成|令和)\d+年\d+月\d+日"
NOT_CURRENT = r"附則|改正前|^旧|改正法|改正令|による改正"
CITED = r"^(.*?)第([0-9]+)条((?:の[0-9]+)*)"


def plain(text: str) -> str:
    return unicodedata.normalize("NFKC", text).replace(" ", "")


def entries(cases: DataFrame, with_commas: list[str] = ()) -> DataFrame:
    """(id, nr, law, path, raw) of each provision that a case's lists name, in order; cases: (id, kankeihrei).

    Lists are split into entries, one row each. An entry that cites an article may name its
    law; one without a number is a law's name alone. The law of any other is the last one
    named before it in the case, over all its lines. Titles that hold a comma stay whole.
    """
    kept, mark = F.col("line"), "\u0001"
    for title in sorted(with_commas, key=len, reverse=True):
        kept = F.replace(kept, F.lit(title), F.lit(title.replace("、", mark)))
    lines = cases.select("id", F.posexplode(F.col("kankeihrei")).alias("line_nr", "line")).withColumn("line", _plain_column("line"))
    rows = lines.select("id", "line_nr", F.posexplode(F.split(kept, "[、，,]")).alias("part_nr", "raw")).withColumn("raw", F.replace("raw", F.lit(mark), F.lit("、")))
    cites = F.col("raw").rlike(CITED)
    name = F.regexp_replace(F.regexp_extract("raw", CITED, 1), r"\(.*?\)", "")
    named = F.when(cites, F.when(name != "", name)).when((F.col("raw") != "") & ~F.contains("raw", F.lit("第")), F.col("raw"))
    order = Window.partitionBy("id").orderBy("line_nr", "part_nr").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("law", F.last(named, ignorenulls=True).over(order)).withColumn("nr", F.struct("line_nr", "part_nr"))
    path = F.concat(F.regexp_extract("raw", CITED, 2), F.replace(F.regexp_extract("raw", CITED, 3), F.lit("の"), F.lit("-")))
    return rows.filter(cites & F.col("law").isNotNull()).select("id", "nr", "law", path.alias("path"), "raw")


def _plain_column(column: str) -> Column:
    """``plain`` of a column, in Arrow batches: the engine has no NFKC of its own."""

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else plain(t))

    return run(column)


def resolve_gold(cases: DataFrame, laws: DataFrame, articles: DataFrame, with_commas: list[str] = ()) -> DataFrame:
    """(id, gold_articles, external_refs, out_of_scope_refs, unresolved). cases: (id, kankeihrei); laws: (name, law_id) in plain spelling; articles: (id)."""
    names = F.create_map(*[F.lit(plain(x)) for kv in LIST_NAMES.items() for x in kv])
    refs = entries(cases, with_commas)
    refs = refs.withColumn("name", F.coalesce(names[F.col("law")], F.regexp_replace("law", "^[「」『』()（）]+|[「」『』()（）]+$", "")))
    found = refs.join(laws.select("name", "law_id"), "name", "left").withColumn("node", F.concat_ws("_a", "law_id", "path"))
    found = found.join(articles.select(F.col("id").alias("node"), F.lit(True).alias("there")), "node", "left")
    bucket = F.when(F.col("law").rlike(OUTSIDE), "external").when(F.col("law").rlike(NOT_CURRENT), "out_of_scope").when(F.col("there"), "gold").otherwise("unresolved")
    each = found.withColumn("bucket", bucket)

    def gathered(kind: str, value: str):
        rows = F.array_sort(F.collect_list(F.when(F.col("bucket") == kind, F.struct("nr", F.col(value).alias("v")))))
        return F.transform(rows, lambda x: x["v"])

    sums = each.groupBy("id").agg(F.array_distinct(gathered("gold", "node")).alias("gold_articles"), gathered("external", "raw").alias("external_refs"), gathered("out_of_scope", "raw").alias("out_of_scope_refs"), gathered("unresolved", "raw").alias("unresolved"))
    none = F.array().cast("array<string>")
    return cases.select("id").join(sums, "id", "left").select("id", *[F.coalesce(c, none).alias(c) for c in ("gold_articles", "external_refs", "out_of_scope_refs", "unresolved")])


def gold_statistics(cases: DataFrame, resolved: DataFrame, top: int = 25) -> tuple[DataFrame, DataFrame]:
    """(metric, value) over all cases: references, those in each bucket, cases with and without gold; and the most frequent unresolved ones."""
    size = lambda c: F.sum(F.size(c))
    one = resolved.agg(
        F.count("*").alias("cases"),
        F.sum((F.size("gold_articles") > 0).cast("int")).alias("cases_with_gold"),
        size("gold_articles").alias("resolved"),
        size("external_refs").alias("external"),
        size("out_of_scope_refs").alias("out_of_scope"),
        size("unresolved").alias("unresolved"),
    )
    metrics = one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.coalesce(F.col(c), F.lit(0)).cast("long").alias("value")) for c in one.columns])).alias("m")).select("m.*")
    lost = resolved.select(F.explode("unresolved").alias("raw")).groupBy("raw").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "raw").limit(top)
    return metrics, lost


def gold_rows(cases: DataFrame, laws: DataFrame, articles: DataFrame) -> DataFrame:
    """GOLD rows: each case with its question, its answer and the buckets of what its lists name. laws: (name, law_id) as titled; a plain spelling that several laws share is none's."""
    spelt = unambiguous(laws.select(_plain_column("name").alias("name"), "law_id"), "name", "law_id")
    commas = [r["name"] for r in spelt.filter(F.contains("name", F.lit("、"))).select("name").collect()]  # a few hundred titles
    found = resolve_gold(cases, spelt, articles, commas)
    return cases.select("id", F.col("shokai").alias("query"), F.col("kaito").alias("answer")).join(found, "id")
