"""Table mappings from an XML mapping file.

Format: ``<sources>`` with ``<source source_db_name=.. target_db_name=..>``
elements, each holding ``<table source_schema=.. source_table=..
target_schema=.. target_table=.. pk_column=.. ts_column=..>`` elements.
Connection ids are kept as extra attributes; reading the sources themselves
is up to the caller (Parquet paths, JDBC, ...).
"""

from __future__ import annotations

import xml.etree.ElementTree as ET

from ambry.plans.sync import TableMapping

REQUIRED_TABLE_ATTRS = ("source_schema", "source_table", "target_schema", "target_table",
                        "pk_column", "ts_column")


def load_mappings(path: str) -> list[TableMapping]:
    """Parse and validate a mapping file; raises ``ValueError`` listing every problem."""
    root = ET.parse(path).getroot()
    problems, out = [], []
    for i, src in enumerate(root.findall("source")):
        for j, tbl in enumerate(src.findall("table")):
            missing = [a for a in REQUIRED_TABLE_ATTRS if not (tbl.get(a) or "").strip()]
            if missing:
                problems.append(f"source {i + 1}, table {j + 1}: missing {', '.join(missing)}")
                continue
            out.append(TableMapping(
                source_table=tbl.get("source_table"), target_table=tbl.get("target_table"),
                pk=[c.strip() for c in tbl.get("pk_column").split(",")],
                ts_column=tbl.get("ts_column"),
                source_db_name=src.get("source_db_name", ""), source_schema=tbl.get("source_schema"),
                target_db_name=src.get("target_db_name", ""), target_schema=tbl.get("target_schema"),
                extra={**{k: v for k, v in src.attrib.items() if k.endswith("conn_id")},
                       **({"table_no": int(tbl.get("table_no"))} if tbl.get("table_no") else {})}))
    if problems:
        raise ValueError("; ".join(problems))
    keys = [(m.target_db_name.lower(), m.target_schema.lower(), m.target_table.lower()) for m in out]
    dups = sorted({k for k in keys if keys.count(k) > 1})
    if dups:
        raise ValueError(f"target mapped twice: {dups}")
    return out
