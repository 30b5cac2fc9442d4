"""The engine's questions as tools over standard input and output: one JSON-RPC message a line.

Errors of a question are values ({"error": ...}), so a caller can read and mend them; only
malformed messages get a protocol error.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Callable
from typing import Any, TextIO

from pyspark.sql import functions as F

from lexloom.api import Engine

PROTOCOL = "2024-11-05"
_TEXT, _NUMBER, _FLAG = {"type": "string"}, {"type": "integer"}, {"type": "boolean"}


class Tools:
    """Eight questions to a corpus; each gives plain values."""

    def __init__(self, engine: Engine):
        self.engine = engine
        self.known: dict[str, tuple[Callable, str, dict, list[str]]] = {
            "resolve_citation": (self.resolve_citation, "The laws and articles that a text cites.", {"text": _TEXT}, ["text"]),
            "what_cites": (self.what_cites, "Laws that cite a law, the heaviest first.", {"law": _TEXT, "limit": _NUMBER}, ["law"]),
            "what_law_cites": (self.what_law_cites, "Laws that a law cites, the heaviest first.", {"law": _TEXT, "limit": _NUMBER}, ["law"]),
            "citation_path": (self.citation_path, "A shortest chain of citations from one law to another.", {"a": _TEXT, "b": _TEXT, "max_hops": _NUMBER}, ["a", "b"]),
            "get_law": (self.get_law, "A law by id or name, with how much it cites and is cited.", {"query": _TEXT}, ["query"]),
            "pending_amendments": (self.pending_amendments, "Versions of a law that are still to come.", {"law": _TEXT}, ["law"]),
            "get_provision": (self.get_provision, "A provision's text, and what it cites and is cited by.", {"citation_text": _TEXT}, ["citation_text"]),
            "search_statutes": (self.search_statutes, "Provisions that hold all words; or the best for a question, if natural.", {"query": _TEXT, "law": _TEXT, "natural": _FLAG, "limit": _NUMBER}, ["query"]),
        }

    def call(self, name: str, arguments: dict) -> Any:
        if name not in self.known:
            return {"error": f"unknown tool: {name}"}
        try:
            return self.known[name][0](**arguments)
        except Exception as e:  # noqa: BLE001  whatever a question meets is told to the one who asked
            return {"error": str(e).splitlines()[0] if str(e) else type(e).__name__}

    def described(self) -> list[dict]:
        return [{"name": name, "description": about, "inputSchema": {"type": "object", "properties": of, "required": needed}} for name, (_, about, of, needed) in self.known.items()]

    def resolve_citation(self, text: str) -> list[dict]:
        return [r | {"resolved": r["law_id"] is not None} for r in self.engine.resolve_citation(text)]

    def what_cites(self, law: str, limit: int = 30) -> dict:
        return self.engine.what_cites(law, limit)

    def what_law_cites(self, law: str, limit: int = 30) -> dict:
        return self.engine.what_law_cites(law, limit)

    def citation_path(self, a: str, b: str, max_hops: int = 4) -> dict:
        found = self.engine.citation_path(a, b, max_hops)
        return found if found.get("path") or "error" in found else found | {"note": f"no citation path within {max_hops} hops"}

    def get_law(self, query: str) -> dict:
        return self.engine.get_law(query)

    def pending_amendments(self, law: str) -> dict:
        found = self.engine.resolve_law(law)
        if "error" in found:
            return found
        return {"law": found["title"], "law_id": found["law_id"], "pending": [r.asDict() for r in self.engine.pending(found["law_id"]).collect()]}

    def get_provision(self, citation_text: str) -> dict:
        found = self.engine.get_provision(citation_text)
        if "error" in found:
            return found
        return found | {"pending": [r.asDict() for r in self.engine.pending(found["node"].split("_")[0]).collect()]}

    def search_statutes(self, query: str, law: str | None = None, natural: bool = False, limit: int = 10) -> dict:
        rows = self.engine.search(query, law=law, natural=natural, limit=limit)
        snippet = F.col("snippet") if "snippet" in rows.columns else F.substring("body", 1, 80)
        return {"hits": [r.asDict() for r in rows.select("node_id", "heading", snippet.alias("snippet")).collect()]}


def answer(tools: Tools, message: dict) -> dict | None:
    """The answer to one message; None to a notification."""
    method, number = message.get("method"), message.get("id")
    if number is None:
        return None
    if method == "initialize":
        result = {"protocolVersion": PROTOCOL, "capabilities": {"tools": {}}, "serverInfo": {"name": "lexloom", "version": "1"}}
    elif method == "ping":
        result = {}
    elif method == "tools/list":
        result = {"tools": tools.described()}
    elif method == "tools/call":
        params = message.get("params") or {}
        value = tools.call(params.get("name", ""), params.get("arguments") or {})
        result = {"content": [{"type": "text", "text": json.dumps(value, ensure_ascii=False, default=str)}], "isError": isinstance(value, dict) and "error" in value}
    else:
        return {"jsonrpc": "2.0", "id": number, "error": {"code": -32601, "message": f"unknown method: {method}"}}
    return {"jsonrpc": "2.0", "id": number, "result": result}


def serve(tools: Tools, source: TextIO = sys.stdin, out: TextIO = sys.stdout) -> None:
    for line in source:
        if not line.strip():
            continue
        try:
            said = answer(tools, json.loads(line))
        except ValueError as e:
            said = {"jsonrpc": "2.0", "id": None, "error": {"code": -32700, "message": str(e)}}
        if said is not None:
            print(json.dumps(said, ensure_ascii=False), file=out, flush=True)
