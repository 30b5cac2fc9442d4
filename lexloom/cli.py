"""Command line: python -m lexloom.cli VERB ..."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexloom.session import local_session


def _show(value, as_json: bool) -> None:
    if isinstance(value, DataFrame):
        for row in value.toJSON().toLocalIterator():
            print(row)
    elif isinstance(value, list):
        for x in value:
            print(json.dumps(x, ensure_ascii=False, default=str))
    elif as_json or not isinstance(value, dict) or "text" not in value:
        print(json.dumps(value, ensure_ascii=False, default=str))
    else:
        print(value["text"])


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="lexloom")
    verbs = top.add_subparsers(dest="verb", required=True)

    def verb(name: str, *args: str, **options) -> argparse.ArgumentParser:
        p = verbs.add_parser(name)
        for a in args:
            p.add_argument(a)
        p.add_argument("--json", action="store_true")
        for o, settings in options.items():
            p.add_argument(f"--{o.replace('_', '-')}", **settings)
        return p

    flag, number = {"action": "store_true"}, {"type": int, "default": 20}
    verb("fetch", "output", zip={"default": None}, url={"default": None})
    verb("download", "manifest", "output", base={"default": None})
    verb("build", "input", "output", as_of={"required": True}, law_list={"default": None}, aliases={"default": None, "nargs": "*"}, limit={"type": int, "default": None}, no_cites=flag, dump_unresolved={"default": None})
    verb("index", "corpus")
    verb("eval", "corpus", "gold", out={"default": None}, depth={"type": int, "default": 100})
    verb("gold", "corpus", "cases", "output")
    verb("mcp", "corpus")
    verb("explorer", "corpus", "output")
    verb("validate", "corpus", kpi=flag)
    verb("export", "corpus", "output")
    verb("pack", "corpus", "output")
    verb("unpack", "corpus")
    verb("search", "corpus", "query", law={"default": None}, law_type={"default": None}, section={"default": "all"}, all_versions=flag, natural=flag, limit=number, offset={"type": int, "default": 0})
    verb("get", "corpus", "query")
    verb("refs", "corpus", "query", direction={"default": "both"}, limit={"type": int, "default": 200})
    verb("law", "corpus", "query")
    verb("toc", "corpus", "query")
    verb("pending", "corpus", law={"default": None}, until={"default": None})
    verb("cites", "corpus", "query")
    verb("cited", "corpus", "query")
    verb("path", "corpus", "start", "goal")
    verb("stats", "corpus")
    verb("versions", "input")
    return top


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    if a.verb == "fetch":
        from lexloom.sources.snapshot import take_snapshot

        _show(take_snapshot(a.output, a.zip, a.url), True)
        return 0
    if a.verb == "download":
        from pathlib import Path

        from lexloom.sources.snapshot import download_checked

        found = json.loads(Path(a.manifest).read_text(encoding="utf-8"))
        _show({"fetched": download_checked(found, a.base or Path(a.manifest).resolve().parent.as_uri(), Path(a.output))}, True)
        return 0
    spark = local_session("lexloom-cli")
    from lexloom import api
    from lexloom.operators import build as builds
    from lexloom.operators import checks
    from lexloom.operators.resolve import unresolved
    from lexloom.sources import release, snapshot
    from lexloom.sources import statutes as X

    if a.verb == "versions":
        _show(builds.supersedes_edges(X.read_documents(spark, a.input)), True)
        return 0
    if a.verb == "build":
        laws = X.read_law_list(spark, a.law_list) if a.law_list else None
        aliases = spark.createDataFrame(sorted(snapshot.load_aliases(*(a.aliases or [])).items()), "name string, canonical string")
        documents = X.read_documents(spark, a.input)
        if a.limit:  # the first laws by id, as asked
            documents = documents.join(documents.select("law_id").distinct().orderBy("law_id").limit(a.limit), "law_id", "left_semi")
        built = builds.build(documents, a.as_of, laws, aliases, not a.no_cites)
        api.save(built, a.output)
        if a.dump_unresolved:
            release.write_jsonl(unresolved(built.mentions), a.dump_unresolved, ["occ_seq"])
        return 0
    if a.verb == "pack":
        api.pack(a.corpus, a.output, spark)
        return 0
    if a.verb in ("unpack", "index"):
        _show({"chunks": api.unpack(a.corpus, spark)}, True)
        return 0
    e = api.Engine(spark, a.corpus)
    if a.verb == "mcp":
        from lexloom.server import Tools, serve

        serve(Tools(e))
        return 0
    if a.verb == "eval":
        from lexloom.operators.retrieval import evaluate

        result = evaluate(e, release.read_jsonl(spark, a.gold, release.GOLD), a.depth)
        if a.out:
            release.write_json(result, a.out)
        _show(result, True)
        return 0
    if a.verb == "gold":
        from lexloom.operators.gold import gold_rows, gold_statistics

        cases = release.read_cases(spark, a.cases)
        rows = gold_rows(cases, e.laws_.select(F.col("title").alias("name"), "law_id"), e.nodes_.filter("type = 'Article'").select("id"))
        release.write_jsonl(rows, a.output, ["id"])
        metrics, lost = gold_statistics(cases, rows)
        _show({r["metric"]: r["value"] for r in metrics.collect()} | {"top_unresolved": [[r["raw"], r["n"]] for r in lost.collect()]}, True)
        return 0
    if a.verb == "explorer":
        from pathlib import Path

        from lexloom.sources.pages import explorer

        laws = e.laws_.select("law_id", F.col("title").alias("name"), F.col("law_type").alias("type"), "next_enforcement_date")
        Path(a.output).write_text(explorer(laws, e.pairs_), encoding="utf-8")
        return 0
    if a.verb == "validate":
        outcomes = e.mentions_.groupBy("outcome").count().withColumnRenamed("count", "n")
        rows = checks.all_checks(e.nodes_, X.contains_edges(e.nodes_), e.edges_, outcomes).collect()
        _show([r.asDict() for r in rows], True)
        failed = any(not r["passed"] and (r["severity"] == "FAIL" or (a.kpi and r["check"] == "V07")) for r in rows)
        return 2 if failed else 1 if any(not r["passed"] for r in rows) else 0
    if a.verb == "export":
        release.write_csv(release.law_table(e.nodes_), f"{a.output}/laws")
        release.write_csv(release.law_to_law(e.edges_, e.nodes_), f"{a.output}/cites_law_to_law")
        release.write_csv(release.pending_table(e.pending_, e.nodes_), f"{a.output}/pending_versions")
        release.write_edges(release.external_edges(e.edges_), f"{a.output}/cites_edges")
        release.write_edges(e.edges_, f"{a.output}/cites_all_edges")
        release.write_json(release.release_stats(e.nodes_, e.edges_, e.mentions_, e.pending_), f"{a.output}/release_stats.json")
        return 0
    found = None
    if a.verb == "search":
        found = e.search(a.query, a.law, a.law_type, a.section, a.all_versions, a.limit, a.offset, a.natural)
    elif a.verb == "get":
        found = e.get_provision(a.query)
    elif a.verb == "refs":
        node = e.lookup(a.query)
        found = node if "error" in node else [r.asDict() for df in e.refs(node["node"]["id"], a.direction, limit=a.limit).values() for r in df.collect()]
    elif a.verb in ("law", "toc"):
        law = e.get_law(a.query)
        found = law if a.verb == "law" or "error" in law else e.toc(law["law_id"])
    elif a.verb == "pending":
        found = e.pending(a.law, a.until)
    elif a.verb == "cites":
        found = e.what_law_cites(a.query)
    elif a.verb == "cited":
        found = e.what_cites(a.query)
    elif a.verb == "path":
        found = e.citation_path(a.start, a.goal)
    elif a.verb == "stats":
        found = e.stats()
    _show(found, a.json)
    return 1 if isinstance(found, dict) and "error" in found else 0


if __name__ == "__main__":
    sys.exit(main())
