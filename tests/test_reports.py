"""Reports are read back as they were written; what fails leaves nothing."""

import re
import zipfile
from xml.etree import ElementTree

import pytest
from lexipress.sources import reports
from pyspark.sql import functions as F

ROWS = [(1, "a|b", "one\ntwo", 1.5), (2, "a|b", "<tag> & 'q' \x07", None), (3, "Ы/ы", None, -2.0), (4, "a|b", "back\\slash", 0.0)]


@pytest.fixture
def rows(spark):
    reports.register(spark)
    return spark.createDataFrame(ROWS, "id int, part string, said string, score double").repartition(3, "id")


def sheets_of(path):
    """Each sheet's rows by its name, as another reader of workbooks finds them."""
    ns = {"m": reports._MAIN}
    with zipfile.ZipFile(path) as book:
        types = book.read("[Content_Types].xml").decode()
        names = ElementTree.fromstring(book.read("xl/workbook.xml")).findall("m:sheets/m:sheet", ns)
        links = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
        out = {}
        for n in names:
            target = links[n.get(f"{{{reports._OFFICE}}}id")]
            assert f"/xl/{target}" in types
            page = ElementTree.fromstring(book.read(f"xl/{target}"))
            cell = lambda c: c.findtext("m:is/m:t", namespaces=ns) if c.get("t") else None if c.find("m:v", ns) is None else float(c.findtext("m:v", namespaces=ns))
            out[n.get("name")] = [[cell(c) for c in r.findall("m:c", ns)] for r in page.findall("m:sheetData/m:row", ns)]
    return out


def test_workbook(rows, tmp_path, monkeypatch):
    path = tmp_path / "r.xlsx"
    rows.write.format("report").options(path=str(path), kind="workbook", sheet="part").mode("append").save()
    found = sheets_of(path)
    assert found.keys() == {"a|b", "Ы_ы"} and found["Ы_ы"] == [["id", "said", "score"], [3.0, None, -2.0]]
    assert sorted(found["a|b"][1:]) == [[1.0, "one\ntwo", 1.5], [2.0, "<tag> & 'q' ", None], [4.0, "back\\slash", 0.0]]
    assert [p.name for p in tmp_path.iterdir()] == ["r.xlsx"]


def test_markdown(rows, tmp_path):
    path = tmp_path / "r.md"
    rows.write.format("report").options(path=str(path), kind="markdown", sheet="part", title="Review").mode("append").save()
    text = path.read_text()
    assert text.startswith("# Review\n") and re.findall("^## (.*)$", text, re.M) == ["a|b", "Ы/ы"]
    cells = [[c.strip().replace("<br>", "\n").replace("\\|", "|").replace("\\\\", "\\") for c in re.split(r"(?<!\\)\|", line)[1:-1]] for line in text.splitlines() if line.startswith("| ") and "id" not in line]
    assert sorted(cells) == [["1", "one\ntwo", "1.5"], ["2", "<tag> & 'q' \x07".strip(), ""], ["3", "", "-2.0"], ["4", "back\\slash", "0.0"]]


def test_overwrite_and_refusal(rows, tmp_path):
    path = tmp_path / "r.md"
    write = lambda df, mode: df.write.format("report").options(path=str(path)).mode(mode).save()
    write(rows, "append")
    with pytest.raises(Exception, match="r.md"):
        write(rows, "append")
    write(rows.where("id = 1"), "overwrite")
    assert path.read_text().count("\n| ") == 2 and [p.name for p in tmp_path.iterdir()] == ["r.md"]


def test_an_aborted_task_leaves_nothing(spark, rows, tmp_path):
    @F.udf("string")
    def breaks(i):
        if i == 3:
            raise ValueError("broken row")
        return str(i)

    with pytest.raises(Exception, match="broken row"):
        rows.withColumn("said", breaks("id")).write.format("report").options(path=str(tmp_path / "r.xlsx"), kind="workbook").mode("append").save()
    assert list(tmp_path.iterdir()) == []


def test_long_sheets_go_on(rows, tmp_path, monkeypatch):
    """The commit runs where Spark plans the write, so the limit is tried on the writer itself."""
    monkeypatch.setattr(reports, "SHEET_ROWS", 3)
    writer = reports.Workbook(rows.schema, {"path": str(tmp_path / "w.xlsx")}, True)
    parts = writer.write(iter(rows.collect()))
    writer.commit([parts, None])
    found = sheets_of(tmp_path / "w.xlsx")
    assert list(found) == ["Report", "Report 2"] and [len(r) for r in found.values()] == [3, 3]
    assert found["Report 2"][0] == ["id", "part", "said", "score"]


def test_an_empty_report(spark, rows, tmp_path):
    rows.limit(0).write.format("report").options(path=str(tmp_path / "e.xlsx"), kind="workbook", title="Empty").mode("append").save()
    assert sheets_of(tmp_path / "e.xlsx") == {"Empty": [["id", "part", "said", "score"]]}
