"""Staging files: a JSON file with a source's rows, issues and proposals, and its Markdown form for people.

Tasks turn ordered rows into the texts that they add to both files and write these down in the shared
folder, and tasks copy them to their places in the two files; the driver knows the counts only.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from ..operators.materialize import mounted_folder
from ..plans.staging import Staging, cell, table_head, table_line
from .joined import Parts, join_files, part_path

#: Rows that tasks turn into one text.
BLOCK_ROWS = 1000


def texts(rows: DataFrame, order: list[str], shown: list[str], with_lines: bool) -> list[Row]:
    """(place, attempt, n, folder) of the tasks that wrote JSON elements and table lines of successive rows, in order."""
    folder = mounted_folder(rows.sparkSession, "texts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, n = Parts(folder), 0
        for b in batches:
            for first in range(0, b.num_rows, BLOCK_ROWS):
                found = b.slice(first, BLOCK_ROWS).to_pylist()
                elements = ",".join("\n    " + json.dumps(r, ensure_ascii=False, indent=2).replace("\n", "\n    ") for r in found)
                parts.add("json", (("," if n else "") + elements).encode())
                if with_lines:
                    parts.add("md", "".join(table_line(r, shown) + "\n" for r in found).encode())
                n += len(found)
        parts.close()
        if n:
            yield pa.RecordBatch.from_pydict({"place": [parts.place], "attempt": [parts.attempt], "n": [n], "folder": [str(folder)]})

    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).select(*shown)
    return sorted(ranged.mapInArrow(run, "place long, attempt long, n long, folder string").collect())


def written(found: list[Row], suffix: str) -> list[Path]:
    return [part_path(Path(r.folder), r.place, r.attempt, suffix) for r in found]


def sections(staging: Staging, source: str) -> dict[str, tuple[list[Row], list[str]]]:
    """Parts and columns of each list of the file, in its order."""
    key, hidden = ("pig_id", {"position", "source_id", "nr_inwent"}) if source == "pig" else ("globalid", {"position", "source_id"})
    issues = staging.issues.withColumn(key, F.col("source_id"))
    told = ["code", "severity", "record_number", key]
    told += [c for c in staging.issues.columns if c not in hidden | set(told)]
    out = {"rows": (texts(staging.rows, ["record_number"], staging.rows.columns, True), staging.rows.columns), "issues": (texts(issues, ["record_number", "position"], told, True), told)}
    if staging.updates is not None:
        out["matched_measurements"] = (texts(staging.updates, ["record_number"], staging.updates.columns, False), [])
    for name, d in (("proposed_caves", staging.caves), ("proposed_objects", staging.objects)):
        out[name] = (texts(d, ["record_number"], [c for c in d.columns if c != "record_number"], False), [])
    return out


def counts_of(staging: Staging, source: str, found: dict[str, tuple[list[Row], list[str]]]) -> dict[str, int]:
    n = {name: sum(r.n for r in parts) for name, (parts, _) in found.items()}
    out = {"record_count": n["rows"]}
    if source == "pig":
        out |= {"proposed_cave_count": n["proposed_caves"], "proposed_object_count": n["proposed_objects"], "cave_only_count": n["rows"] - n["proposed_objects"]}
    else:
        of = {r["status"]: r["count"] for r in staging.rows.groupBy("status").count().collect()}
        out |= {f"{s}_count": of.get(s, 0) for s in ("matched", "new", "unresolved", "rejected")}
    return out | {"issue_count": n["issues"]}


def write_report(staging: Staging, source: str, source_path: str, generated_at: str, folder: str, name: str, title: str) -> list[Path]:
    """The paths of the JSON and the Markdown file, both swapped in whole."""
    out = Path(folder)
    out.mkdir(parents=True, exist_ok=True)
    found = sections(staging, source)
    counts = counts_of(staging, source, found)
    paths = [out / f"{name}.json", out / f"{name}.md"]
    for path, pieces in zip(paths, (_json_pieces, _markdown_pieces), strict=True):
        join_files(staging.rows.sparkSession, path, pieces(found, {"generated_at": generated_at, "source_path": source_path} | counts, title))
    return paths


def _json_pieces(found: dict[str, tuple[list[Row], list[str]]], head: dict, _: str) -> list[bytes | Path]:
    out: list[bytes | Path] = [json.dumps(head, ensure_ascii=False, indent=2).removesuffix("\n}").encode()]
    for name, (parts, _columns) in found.items():
        out.append(f',\n  "{name}": ['.encode())
        for k, part in enumerate(written(parts, "json")):
            out += [b",", part] if k else [part]
        out.append(b"\n  ]" if parts else b"]")
    return [*out, b"\n}\n"]


def _markdown_pieces(found: dict[str, tuple[list[Row], list[str]]], head: dict, title: str) -> list[bytes | Path]:
    shown = "\n".join(f"- {k}: {v}" for k, v in head.items() if k.endswith("_count"))
    out: list[bytes | Path] = [f"# {title}\n\nGenerated at {head['generated_at']} from {cell(head['source_path'])}.\n\n{shown}\n".encode()]
    for name in ("rows", "issues"):
        parts, columns = found[name]
        out.append(f"\n## {name.capitalize()}\n\n".encode())
        out += [("\n".join(table_head(columns)) + "\n").encode(), *written(parts, "md")] if parts else [b"None.\n"]
    return out
