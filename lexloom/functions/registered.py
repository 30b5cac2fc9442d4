"""The citation functions under names of their own in SQL: ``register(spark)``."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from lexloom.functions import citations as C
from lexloom.functions.ids import parse_id
from lexloom.functions.numerals import to_int


def _map(fn, kind: str):
    """A function of one text as an Arrow-batched column function; what it refuses is null."""

    @F.pandas_udf(kind)
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else fn(t))

    return run


def _kind(node_id: str) -> str | None:
    try:
        return parse_id(node_id)["kind"]
    except ValueError:
        return None


class Mentions:
    """SELECT * FROM extract_mentions(text): every mention of a text."""

    def eval(self, text: str) -> Iterator[tuple]:
        for m in C.mentions(text):
            yield tuple(m)


class Definitions:
    """SELECT * FROM extract_definitions(text): the short names for laws that a text defines."""

    def eval(self, text: str) -> Iterator[tuple]:
        yield from C.definitions(text)


def register(spark: SparkSession) -> list[str]:
    """Registers the functions and table functions; their names."""
    columns = {"numeral": _map(to_int, "int"), "promulgation_key": _map(C.promulgation_key, "string"), "clean_law_name": _map(C.clean_name, "string"), "citation_continues": _map(C.continues, "boolean"), "is_amending_law": _map(C.is_amending, "boolean"), "node_kind": _map(_kind, "string")}
    for name, fn in columns.items():
        spark.udf.register(name, fn)
    tables = {"extract_mentions": (Mentions, C.SCHEMA.replace("end int", "`end` int")), "extract_definitions": (Definitions, "abbr string, promulgation string, name string")}
    for name, (cls, schema) in tables.items():
        spark.udtf.register(name, F.udtf(cls, returnType=schema))
    return [*columns, *tables]
