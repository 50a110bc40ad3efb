"""Schema contract (S1) and the file-name rule (V1)."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

_TYPES = {"float": DoubleType(), "double": DoubleType(), "int": IntegerType(), "integer": IntegerType()}


# The delivery naming rule, prefix "wafer", date stamp 8 characters, time stamp 6 characters.
@dataclass(frozen=True)
class NamingRule:
    """``<prefix>_<date stamp>_<time stamp>.csv``; only the lengths of the stamps are checked."""
    prefix: str = "wafer"
    date_len: int = 8
    time_len: int = 6


@dataclass(frozen=True)
class Contract:
    schema: StructType
    naming: NamingRule
    n_columns: int
    varchar_len: dict

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.schema.fields]


def spark_type(sql_type: str):
    t = sql_type.strip().lower()
    if t.startswith("varchar") or t.startswith("char") or t in ("string", "text"):
        return StringType()
    if t in _TYPES:
        return _TYPES[t]
    raise ValueError(f"unsupported contract type {sql_type!r}")


def contract_from_dict(d: dict) -> Contract:
    """``StructType`` in contract order plus the naming rule, built once (never inferred)."""
    fields, lengths = [], {}
    for name, typ in d["ColName"].items():
        fields.append(StructField(name, spark_type(typ), True))
        t = typ.strip().lower()
        if t.startswith("varchar(") and t.endswith(")"):
            lengths[name] = int(t[len("varchar("):-1])
    sample = d.get("SampleFileName", "wafer_00000000_000000.csv")
    rule = NamingRule(prefix=sample.split("_")[0], date_len=int(d["LengthOfDateStampInFile"]),
                      time_len=int(d["LengthOfTimeStampInFile"]))
    return Contract(StructType(fields), rule, int(d["NumberofColumns"]), lengths)


def contract_schema(json_path: str) -> Contract:
    with open(json_path) as fh:
        return contract_from_dict(json.load(fh))


def sensor_contract(n_sensors: int = 590, with_label: bool = True, id_col: str = "Wafer", label: str = "Output") -> dict:
    """A contract dict of the reference's shape: id, N float sensors, optional int label."""
    cols = {id_col: "varchar(255)"}
    cols.update({f"Sensor{i}": "float" for i in range(1, n_sensors + 1)})
    if with_label:
        cols[label] = "int"
    return {"SampleFileName": "wafer_08012020_120000.csv", "LengthOfDateStampInFile": 8,
            "LengthOfTimeStampInFile": 6, "NumberofColumns": len(cols), "ColName": cols}


def name_ok(name: Column, rule: NamingRule = NamingRule()) -> Column:
    """V1: cut at the first '.csv', split on '_': 3 parts, prefix, stamp lengths."""
    base = F.substring_index(name, ".csv", 1)
    parts = F.split(base, "_")
    return ((F.size(parts) == 3) & (F.get(parts, 0) == F.lit(rule.prefix))
            & (F.length(F.get(parts, 1)) == rule.date_len) & (F.length(F.get(parts, 2)) == rule.time_len))
