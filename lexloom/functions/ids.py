"""Identifiers of nodes: built, parsed and checked.

law, law_aARTICLE, law_aARTICLE_pN, law_aARTICLE_pN_iITEM; law_asup-TAG-ARTICLE and so on
for supplementary provisions; law_at-KINDNUMBER for attachments; law_hPATH for divisions.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexloom.functions.numerals import to_int

LAW_ID = r"^[0-9]{3}[A-Z][A-Z0-9][A-Z0-9]?[0-9A-Z]+$"
NODE_ID = r"^[A-Za-z0-9]+(?:_a[A-Za-z0-9][A-Za-z0-9_-]*|_at-[A-Za-z0-9][A-Za-z0-9_-]*|_h[A-Z][A-Za-z0-9_-]*)(?:_add|_attachment|_DOC)?$"


def number_path(num: str | None) -> str | None:
    """'4_3_2' as '4-3-2'; parts may be kanji; None if any part is no number."""
    if not num:
        return None
    parts = [p if p.isdigit() else to_int(p) for p in num.split("_")]
    return None if any(p is None for p in parts) else "-".join(map(str, parts))


def article_id(law: str, article: str, paragraph: int | None = None, item: str | int | None = None, suppl: str | None = None) -> str:
    """suppl: the tag of the supplementary block, None in the main text."""
    if not law or not article:
        raise ValueError("a law and an article are needed")
    if item is not None and paragraph is None:
        raise ValueError("an item needs a paragraph")
    head = f"{law}_a{article}" if suppl is None else f"{law}_asup-{suppl}-{article}"
    return head + (f"_p{paragraph}" if paragraph is not None else "") + (f"_i{item}" if item is not None else "")


def attachment_id(law: str, annex: str) -> str:
    if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9_-]*", annex or ""):
        raise ValueError(f"no attachment number: {annex!r}")
    return f"{law}_at-{annex}"


def division_id(law: str, path: str) -> str:
    if not re.fullmatch(r"[A-Z][A-Za-z0-9_-]*", path or ""):
        raise ValueError(f"no division path: {path!r}")
    return f"{law}_h{path}"


def parse_id(node_id: str) -> dict:
    """law_id, kind, article_path, paragraph_num, item_path, suppl_tag, rest. Items of branched numbers are parsed too."""
    found = re.fullmatch(r"(?P<law>[A-Za-z0-9]+)(?:_at-(?P<annex>.+)|_h(?P<division>[A-Z].*)|_a(?:sup-(?P<tag>[A-Za-z0-9]+)-)?(?P<art>[0-9][0-9-]*)(?:_p(?P<p>\d+)(?:_i(?P<i>\d+(?:-\d+)*))?)?)?", node_id or "")
    if not found:
        raise ValueError(f"no node id: {node_id!r}")
    g = found.groupdict()
    kind = "attachment" if g["annex"] else "hierarchy" if g["division"] else "item" if g["i"] else "paragraph" if g["p"] else "article" if g["art"] else "law"
    return {"law_id": g["law"], "kind": kind, "article_path": g["art"], "paragraph_num": int(g["p"]) if g["p"] else None, "item_path": g["i"], "suppl_tag": g["tag"], "rest": g["annex"] or g["division"]}


def article_of(node_id: Column) -> Column:
    """The article a node lies in; null for attachments, divisions and laws."""
    found = F.regexp_extract(node_id, r"^([A-Za-z0-9]+_a(?:sup-[A-Za-z0-9]+-)?[0-9][0-9-]*)", 1)
    return F.when(found != "", found)


def law_of(node_id: Column) -> Column:
    return F.substring_index(node_id, "_", 1)


def path_key(path: Column) -> Column:
    """'10-2' as [10, 2], which sorts as paths do."""
    return F.transform(F.split(path, "-"), lambda p: F.coalesce(p.try_cast("int"), F.lit(0)))


def law_type(law_id: Column) -> Column:
    code = F.substring(law_id, 4, 2)
    return F.when(code == "AC", "act").when(code == "CO", "cabinet_order").when(code == "IO", "imperial_order").when(code.isin("DF", "DT"), "dajokan").when(code.rlike("^[MR]"), "ministerial").otherwise("other")
