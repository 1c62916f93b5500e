"""Round trips and odd inputs of sources and sinks; files that arrive while a query runs."""

from __future__ import annotations

import base64
import struct

import pytest
from pyspark.sql import functions as F

from ionloom.sources import mgf, tables, xml
from ionloom.streaming.ingest import quantify_stream, stream_spectra

TEXT = """BEGIN IONS
PEPMASS=301.5
CHARGE=1+
SCANS=7
RTINSECONDS=12.5
TITLE=first
39.023602 100
50.5 0
60.5 10
END IONS

BEGIN IONS
SCAN=8
PEPMASS=400.25 1200
70.1 5
61.2 9
END IONS
"""


def test_mgf_reader(spark, tmp_path):
    (tmp_path / "a.mgf").write_text(TEXT)
    rows = {r.scans: r for r in mgf.read_mgf(spark, str(tmp_path / "a.mgf")).collect()}
    assert set(rows) == {7, 8}
    assert rows[7].peaks[0].mz == 39.02360153198242  # single precision
    assert len(rows[7].peaks) == 1  # what has no intensity ends the list
    assert rows[8].rt == -1.0 and rows[8].precursor_mz == 400.25 and [p.mz for p in rows[8].peaks] == sorted(p.mz for p in rows[8].peaks)
    assert rows[7].charge == 1 and rows[7].base_peak_int == 100.0


def test_mgf_without_scan_fails(spark, tmp_path):
    (tmp_path / "b.mgf").write_text("BEGIN IONS\nPEPMASS=1\n5 5\nEND IONS\n")
    with pytest.raises(Exception, match="scan number"):
        mgf.read_mgf(spark, str(tmp_path / "b.mgf")).collect()


def test_mgf_round_trip(spark, tmp_path):
    (tmp_path / "a.mgf").write_text(TEXT)
    first = mgf.read_mgf(spark, str(tmp_path / "a.mgf")).drop("file")
    mgf.write_mgf(first, str(tmp_path / "out"))
    again = mgf.read_mgf(spark, str(tmp_path / "out")).drop("file")
    keep = ["scans", "precursor_mz", "rt", "peaks"]
    assert sorted(map(str, first.select(keep).collect())) == sorted(map(str, again.select(keep).collect()))


def test_table_below_a_preamble(spark, tmp_path):
    (tmp_path / "c.csv").write_text('bio,1,2\nmax,3,4\nmsclusterID,name\n1,"a,b"\n2,NA\n')
    got = tables.read_below_preamble(spark, str(tmp_path / "c.csv"))
    assert [tuple(r) for r in got.orderBy("msclusterID").collect()] == [("1", "a,b"), ("2", None)]


def test_csv_round_trip(spark, tmp_path):
    d = spark.createDataFrame([(1, ["a", "b"], None), (2, [], 0.5)], "id long, tags array<string>, x double")
    tables.write_csv(d, str(tmp_path / "t"), "id")
    got = tables.read_csv(spark, str(tmp_path / "t"), "id long, tags string, x double").orderBy("id").collect()
    assert got[0].tags == "a;b" and got[0].x is None and got[1].x == 0.5


def test_mzxml_and_mzml(spark, tmp_path):
    pairs = base64.b64encode(struct.pack(">4f", 100.5, 10.0, 200.25, 20.0)).decode()
    (tmp_path / "a.mzXML").write_text(f'<msRun><scan num="3" msLevel="2" retentionTime="PT1M2.5S"><precursorMz precursorIntensity="9" precursorCharge="1">301.5</precursorMz><peaks precision="32">{pairs}</peaks></scan></msRun>')
    mz, v = (base64.b64encode(struct.pack("<2d", *x)).decode() for x in ((100.5, 200.25), (10.0, 20.0)))
    array = lambda kind, data: f'<binaryDataArray><cvParam accession="{kind}"/><cvParam accession="MS:1000523"/><binary>{data}</binary></binaryDataArray>'
    (tmp_path / "b.mzML").write_text(f'<mzML><spectrum id="scan=4"><cvParam accession="MS:1000511" value="2"/><cvParam accession="MS:1000016" value="2" unitName="minute"/><cvParam accession="MS:1000744" value="301.5"/>{array("MS:1000514", mz)}{array("MS:1000515", v)}</spectrum></mzML>')
    got = {r.scans: r for r in xml.read_raw(spark, str(tmp_path / "*.mz*ML")).collect()}
    assert got[3].rt == 62.5 and got[4].rt == 120.0
    for r in got.values():
        assert r.precursor_mz == 301.5 and [(p.mz, p.intensity) for p in r.peaks] == [(100.5, 10.0), (200.25, 20.0)]


def test_plain_formats(spark, tmp_path):
    (tmp_path / "a.dta").write_text("301.5 1\n50.5 2\n60.5 3\n")
    (tmp_path / "b.ms2").write_text("H\tx\nS\t5\t5\t400.5\nI\tRTime\t2.0\nZ\t1\t401.5\n70.5 1\n80.5 2\n")
    (tmp_path / "c.pkl").write_text("500.5 10 2\n90.5 4\n")
    assert xml.read_raw(spark, str(tmp_path / "a.dta")).first().precursor_mz == 301.5
    r = xml.read_raw(spark, str(tmp_path / "b.ms2")).first()
    assert (r.scans, r.rt, r.precursor_mz, len(r.peaks)) == (5, 120.0, 400.5, 2)
    assert xml.read_raw(spark, str(tmp_path / "c.pkl")).first().charge == 2


def test_stream_counts_each_file_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.mgf").write_text(TEXT)
    run = lambda: quantify_stream(stream_spectra(spark, str(tmp_path / "in")), 0.025, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    run()
    (tmp_path / "in" / "b.mgf").write_text(TEXT)
    run()
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.agg(F.sum("n_spectra")).first()[0] == 4
