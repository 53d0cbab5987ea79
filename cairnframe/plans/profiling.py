"""Quality profile of source tables: keys, duplicates and numbers, as DataFrames and as a report."""

from __future__ import annotations

import json
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from ..operators.profile import duplicate_examples, duplicate_summary, missing_counts, numeric_profile
from ..sources.tables import ROW_NUMBER, read_source_table
from .staging import markdown_table


@dataclass(frozen=True)
class SourceSpec:
    """Columns of a source that a profile looks at."""

    name: str
    required: list[str]
    keys: list[str]
    duplicates: list[str]
    numbers: list[str]


# Headers of the two registries' exports.
PIG = SourceSpec("PIG", ["ID", "Nazwa", "Nr inw.", "X 1992", "Y 1992", "H (wg PIG)", "B", "L", "Link"], ["ID", "Nazwa", "Nr inw.", "X 1992", "Y 1992"], ["ID", "Nr inw.", "Nazwa"], ["X 1992", "Y 1992", "B", "L", "H (wg PIG)"])
TPN = SourceSpec("TPN", ["GLOBALID", "NAZWA", "NR_INWENT", "X1992", "Y1992", "Z"], ["GLOBALID", "NAZWA", "NR_INWENT", "X1992", "Y1992"], ["GLOBALID", "NR_INWENT", "NAZWA"], ["X1992", "Y1992", "Z"])


def profile_source(table: DataFrame, spec: SourceSpec) -> dict:
    """One pass for missing keys, one for numbers, one aggregation for each column of duplicates."""
    columns = [c for c in table.columns if c != ROW_NUMBER]
    wanted = list(dict.fromkeys([*spec.required, *spec.keys, *spec.duplicates, *spec.numbers]))
    present = [c for c in spec.duplicates if c in columns]
    summary = {r.column_name: r.asDict() for r in duplicate_summary(table, present).collect()} if present else {}
    for c in present:
        examples = duplicate_examples(table, c, ROW_NUMBER).collect()
        summary[c]["examples"] = [{"value": r.value, "count": r.n, "rows": r.first_rows} for r in sorted(examples, key=lambda r: (-r.n, r.value))]
    return {
        "source": spec.name, "record_count": table.count(), "columns": columns, "missing_columns": [c for c in wanted if c not in columns],
        "key_missing": {r.column_name: r.missing for r in missing_counts(table, spec.keys).collect()},
        "duplicates": [summary[c] for c in present], "numbers": [r.asDict() for r in numeric_profile(table, spec.numbers).collect()],
    }


def profile_markdown(profiles: list[dict], generated_at: str) -> str:
    lines = ["# Source profile", "", f"Generated at {generated_at}.", ""]
    for p in profiles:
        lines += [f"## {p['source']}", "", f"- records: {p['record_count']}", f"- columns: {len(p['columns'])}", f"- missing columns: {', '.join(p['missing_columns']) or 'none'}", ""]
        lines += markdown_table([{"key": k, "missing": v} for k, v in p["key_missing"].items()], ["key", "missing"]) + [""]
        lines += markdown_table(p["numbers"], ["column_name", "numeric", "missing", "non_numeric", "min_value", "max_value"]) + [""]
        lines += markdown_table(p["duplicates"], ["column_name", "duplicate_groups", "duplicate_records", "extra_records"]) + [""]
        shown = [{"column": d["column_name"], "value": e["value"], "count": e["count"], "rows": ", ".join(map(str, e["rows"])) + ("+" if e["count"] > len(e["rows"]) else "")} for d in p["duplicates"] for e in d["examples"]]
        lines += markdown_table(shown, ["column", "value", "count", "rows"]) + [""] if shown else []
    return "\n".join(lines)


def profile_sources(spark: SparkSession, paths: dict[str, str], folder: str, generated_at: str) -> list[Path]:
    """JSON and Markdown of the profiles of PIG and TPN files (whichever is given)."""
    specs = {"PIG": PIG, "TPN": TPN}
    profiles = [profile_source(read_source_table(spark, path, trim=False), specs[name]) for name, path in paths.items()]
    out = Path(folder)
    out.mkdir(parents=True, exist_ok=True)
    files = [out / "source-profile.json", out / "source-profile.md"]
    files[0].write_text(json.dumps({"generated_at": generated_at, "profiles": profiles}, ensure_ascii=False, indent=2) + "\n", encoding="utf-8")
    files[1].write_text(profile_markdown(profiles, generated_at), encoding="utf-8")
    return files
