"""Documents of one record in XML: leaves as a map, a history as an array of maps."""

from __future__ import annotations

import xml.etree.ElementTree as ET

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

PARSED = "struct<ok:boolean,key:string,leaves:map<string,string>,events:array<map<string,string>>>"


def plain_name(tag: str) -> str:
    return tag.rpartition("}")[2]


def leaves(element: ET.Element, skip: str, path: tuple[str, ...] = ()) -> dict[str, str]:
    """The texts of all elements without children, by their path; an empty one is left out, as is everything under `skip`."""
    out: dict[str, str] = {}
    for child in element:
        here = (*path, plain_name(child.tag))
        if here[-1] == skip:
            continue
        if len(child):
            out |= leaves(child, skip, here)
        elif (text := (child.text or "").strip()):
            out["/".join(here)] = text
    return out


def parse(text: str | None, key: str, history: str, entry: str) -> dict:
    """One document; not ok if it is empty, no XML, or its root has a namespace."""
    bad = {"ok": False, "key": None, "leaves": {}, "events": []}
    if not text or not text.strip():
        return bad
    try:
        root = ET.fromstring(text)
    except ET.ParseError:
        return bad
    if root.tag.startswith("{"):
        return bad
    found = leaves(root, history)
    past = root.find(history)
    return {"ok": True, "key": found.get(key), "leaves": found, "events": [leaves(e, "") for e in past.findall(entry)] if past is not None else []}


def parsed(column: Column, key: str, history: str, entry: str) -> Column:
    """`PARSED` of an XML column, in Arrow batches: which documents are refused depends on rules that the built-in reader lacks."""

    def run(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([parse(t, key, history, entry) for t in texts], columns=["ok", "key", "leaves", "events"])

    return F.pandas_udf(run, PARSED)(column)
