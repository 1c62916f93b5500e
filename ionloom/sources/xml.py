"""mzML and mzXML: one task a file, spectra as rows; and the plain text formats dta, ms2 and pkl."""

from __future__ import annotations

import base64
import io
import re
import zlib
from xml.etree import ElementTree

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

SCHEMA = "file string, scans long, ms_level int, rt double, precursor_mz double, precursor_intensity double, charge int, peaks array<struct<mz:double,intensity:double>>"
_local = lambda e: e.tag.rsplit("}", 1)[-1]


def _peaks(mz, intensity) -> list[dict]:
    return [{"mz": float(m), "intensity": float(v)} for m, v in sorted(zip(mz, intensity, strict=False))]


def _seconds(text: str | None) -> float:
    if not text:
        return -1.0
    m = re.fullmatch(r"P(?:T)?(?:([\d.]+)H)?(?:([\d.]+)M)?(?:([\d.]+)S)?", text)
    return sum(float(x or 0) * k for x, k in zip(m.groups(), (3600, 60, 1), strict=True)) if m else float(text)


def mzxml(data: bytes):
    for _, e in ElementTree.iterparse(io.BytesIO(data)):
        if _local(e) != "scan":
            continue
        prec = next((x for x in e if _local(x) == "precursorMz"), None)
        own = next((x for x in e if _local(x) == "peaks"), None)
        raw = base64.b64decode(own.text or "") if own is not None else b""
        if own is not None and own.get("compressionType") == "zlib":
            raw = zlib.decompress(raw)
        pairs = np.frombuffer(raw, ">f8" if own is not None and own.get("precision") == "64" else ">f4").reshape(-1, 2)
        yield int(e.get("num", -1)), int(e.get("msLevel", 1)), _seconds(e.get("retentionTime")), float(prec.text) if prec is not None and prec.text else -1.0, float(prec.get("precursorIntensity", -1)) if prec is not None else -1.0, int(prec.get("precursorCharge", 0)) if prec is not None else 0, _peaks(pairs[:, 0], pairs[:, 1])
        e.clear()


def mzml(data: bytes):
    for _, e in ElementTree.iterparse(io.BytesIO(data)):
        if _local(e) != "spectrum":
            continue
        level, rt, prec, strength, charge, arrays = 1, -1.0, -1.0, -1.0, 0, {}
        for x in e.iter():
            name, value = (x.get("accession"), x.get("value")) if _local(x) == "cvParam" else (None, None)
            if name == "MS:1000511":
                level = int(value)
            elif name == "MS:1000016":
                rt = float(value) * (60 if x.get("unitName") == "minute" else 1)
            elif name == "MS:1000744":
                prec = float(value)
            elif name == "MS:1000042":
                strength = float(value)
            elif name == "MS:1000041":
                charge = int(value)
        for x in (x for x in e.iter() if _local(x) == "binaryDataArray"):
            terms = {c.get("accession") for c in x if _local(c) == "cvParam"}
            raw = base64.b64decode(next((c.text or "" for c in x if _local(c) == "binary"), ""))
            raw = zlib.decompress(raw) if "MS:1000574" in terms else raw
            arrays["mz" if "MS:1000514" in terms else "intensity"] = np.frombuffer(raw, "<f4" if "MS:1000521" in terms else "<f8")
        scan = re.search(r"scan=(\d+)", e.get("id", ""))
        yield int(scan[1]) if scan else int(e.get("index", -1)), level, rt, prec, strength, charge, _peaks(arrays.get("mz", []), arrays.get("intensity", []))
        e.clear()


def _numbers(line: str) -> list[float] | None:
    try:
        return [float(x) for x in line.split()]
    except ValueError:
        return None


def dta(data: bytes):
    """A spectrum to a block: mass of the protonated molecule and charge, then peaks."""
    for k, block in enumerate(re.split(r"\n\s*\n", data.decode().strip())):
        rows = [n for n in map(_numbers, block.splitlines()) if n]
        if rows:
            mh, z = rows[0][0], int(rows[0][1])
            yield k + 1, 2, -1.0, (mh + (z - 1) * 1.007276) / z, -1.0, z, _peaks([r[0] for r in rows[1:]], [r[1] for r in rows[1:]])


def pkl(data: bytes):
    """Blocks of precursor mass, intensity and charge, then peaks."""
    for k, block in enumerate(re.split(r"\n\s*\n", data.decode().strip())):
        rows = [n for n in map(_numbers, block.splitlines()) if n]
        if rows:
            yield k + 1, 2, -1.0, rows[0][0], rows[0][1], int(rows[0][2]), _peaks([r[0] for r in rows[1:]], [r[1] for r in rows[1:]])


def ms2(data: bytes):
    """S, I and Z lines, then peaks."""
    for block in re.split(r"(?m)^S\s", data.decode())[1:]:
        lines = block.splitlines()
        head = lines[0].split()
        rt = next((float(x.split()[-1]) * 60 for x in lines if re.match(r"I\s+RTime", x)), -1.0)
        z = next((int(x.split()[1]) for x in lines if x.startswith("Z")), 0)
        rows = [n for n in map(_numbers, (x for x in lines[1:] if x[:1].isdigit())) if n]
        yield int(head[0]), 2, rt, float(head[-1]), -1.0, z, _peaks([r[0] for r in rows], [r[1] for r in rows])


READERS = {"mzxml": mzxml, "mzml": mzml, "dta": dta, "pkl": pkl, "ms2": ms2}


def read_raw(spark: SparkSession, path: str, kind: str | None = None) -> DataFrame:
    """Spectra of mzXML, mzML, dta, pkl or ms2 files, by ending or by `kind`. A file is parsed by one task."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def run(batches):
        for frame in batches:
            for name, data in zip(frame["path"], frame["content"], strict=True):
                reader = READERS[(kind or name.rsplit(".", 1)[-1]).lower()]
                rows = [(name, *r) for r in reader(bytes(data))]
                yield pd.DataFrame(rows, columns=["file", "scans", "ms_level", "rt", "precursor_mz", "precursor_intensity", "charge", "peaks"])

    return files.mapInPandas(run, SCHEMA)
