import gzip
import hashlib
import json
import zipfile

import pytest
from corpus import ACT, ORDER, OTHER, documents

from lexloom import api
from lexloom.cli import main
from lexloom.operators.build import build
from lexloom.sources import snapshot
from lexloom.sources.statutes import read_documents, read_law_list
from lexloom.streaming.versions import ingest, new_documents


@pytest.fixture(scope="module")
def base(tmp_path_factory):
    base = tmp_path_factory.mktemp("raw")
    for law, mst, _, _, content in documents():
        folder = base / f"{law}_{mst}"
        folder.mkdir()
        (folder / f"{law}_{mst}.xml").write_text(content, encoding="utf-8")
    return base


@pytest.fixture(scope="module")
def engine(spark, base, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("corpus") / "c")
    api.save(build(read_documents(spark, str(base)), "20260101"), path)
    return api.Engine(spark, path), path


def test_laws(engine):
    e, _ = engine
    assert e.resolve_law("舟運法")["law_id"] == ACT and e.resolve_law(ORDER)["title"] == "河川舟運法施行令"
    assert "error" in e.resolve_law("無い法") and len(e.resolve_law("河川舟").get("candidates", [])) == 2
    assert e.get_law("港湾法")["cites_count"] == 1
    assert e.what_cites("港湾法")["laws"][0]["law_id"] == ORDER and e.what_law_cites("河川舟運法施行令")["laws"][0]["law_id"] == ACT
    assert e.citation_path("港湾法", "河川舟運法")["path"] == [OTHER, ORDER, ACT]
    assert e.stats()["nodes"]["Law"] == 3


def test_provisions(engine):
    e, _ = engine
    assert e.lookup("河川舟運法附則第二条")["node"]["id"] == f"{ACT}_asup-sp1-2"
    assert e.lookup("河川舟運法第三条第九項")["note"].endswith(f"{ACT}_a3")
    assert "error" in e.lookup("河川舟運法第九十条") and "error" in e.lookup("港湾法附則第一条")
    found = e.get_provision("河川舟運法3条")
    assert f"{ORDER}_a1_p1" in {x["node"] for x in found["cited_by"]}
    assert e.resolve_citation("舟運法第二条と無名法第三条")[0]["law_id"] == ACT
    assert [r.node_id for r in e.search("舟運 定める").collect()] and e.search("港湾とは").count() == 0 and e.search("港湾とは", include_inactive=True).count() == 1
    assert e.pending(ACT).count() == 1 and e.pending(until="20500101").count() == 0
    assert e.children(f"{ACT}_a3").count() == 2


def test_command_line(engine, capsys, tmp_path, spark, monkeypatch):
    _, path = engine
    monkeypatch.setattr("lexloom.cli.local_session", lambda *_: spark)
    assert main(["law", path, "舟運法", "--json"]) == 0 and json.loads(capsys.readouterr().out)["law_id"] == ACT
    assert main(["law", path, "無い法"]) == 1
    assert main(["validate", path]) == 2  # so small a corpus is below the floors of text lengths
    assert '"check": "V05", "severity": "FAIL", "passed": true' in capsys.readouterr().out
    assert main(["export", path, str(tmp_path / "out")]) == 0
    assert main(["pack", path, str(tmp_path / "p")]) == 0 and main(["unpack", str(tmp_path / "p")]) == 0
    assert api.Engine(spark, str(tmp_path / "p")).resolve_law("舟運法")["law_id"] == ACT
    with pytest.raises(SystemExit) as stop:
        main(["nothing"])
    assert stop.value.code == 2


def test_law_list(spark, tmp_path):
    (tmp_path / "l.csv").write_text("﻿法令種別,法令番号,法令名,法令名読み,旧法令名,公布日,改正法令名,改正法令番号,改正法令公布日,施行日,施行日備考,法令ID,本文URL,未施行\n法律,一,新名法,しん,旧名法,,,,,,,L1,u,\n短い,行\n", encoding="utf-8")
    rows = read_law_list(spark, str(tmp_path / "l.csv")).collect()
    assert [(r.law_id, r.old_name) for r in rows] == [("L1", "旧名法")]


def test_snapshot(tmp_path):
    packed = tmp_path / "a.zip"
    with zipfile.ZipFile(packed, "w") as z:
        z.writestr(snapshot.LAW_LIST, "﻿head\nrow\n")
        z.writestr("L1_20200101_0/L1_20200101_0.xml", "<Law/>")
    for _ in range(2):
        stats = snapshot.take_snapshot(str(tmp_path / "live"), str(packed))
    assert (stats["xml_versions"], stats["unique_law_ids"], stats["csv_rows"]) == (1, 1, 1)
    assert (tmp_path / "live.prev").exists() and (tmp_path / "live" / "snapshot.json").exists()
    with zipfile.ZipFile(tmp_path / "b.zip", "w") as z:
        z.writestr("x", "")
    with pytest.raises(ValueError):
        snapshot.take_snapshot(str(tmp_path / "live"), str(tmp_path / "b.zip"))


def test_downloads(tmp_path):
    data = b"data" * 1000
    (tmp_path / "f.gz").write_bytes(gzip.compress(data))
    manifest = {"file": "f.gz", "sha256": hashlib.sha256(data).hexdigest()}
    to, base = tmp_path / "f", f"file://{tmp_path}"
    assert snapshot.download_checked(manifest, base, to) and to.read_bytes() == data
    assert not snapshot.download_checked(manifest, base, to)
    with pytest.raises(RuntimeError):
        snapshot.download_checked(manifest | {"sha256": "0"}, base, to)
    assert not to.exists()


def test_stream(spark, base, tmp_path):
    for _ in range(2):  # the second run finds nothing new
        ingest(new_documents(spark, str(base)), str(tmp_path / "nodes"), str(tmp_path / "state")).awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "nodes")).filter("type = 'Law'").count() == 4
