"""Command line: python -m cairnframe {validate,build-db,export,release,profile,import-pig,import-tpn,apply-review,assign-id}."""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .functions.ids import numbered_id
from .operators import review
from .operators.candidates import staged_candidates
from .operators.resolver import Resolver, constant_resolver, polygon_resolver
from .operators.validation import CatalogInvalidError, formatted, has_errors, require_valid, validate
from .plans import profiling, staging
from .session import build_session
from .sinks import release
from .sinks.staging_file import write_report
from .sources.catalog import CatalogLoadError, load_catalog
from .sources.shapes import load_polygons
from .sources.tables import read_source_table


def now() -> str:
    return dt.datetime.now(dt.UTC).replace(microsecond=0).isoformat().replace("+00:00", "Z")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="cairnframe")
    commands = p.add_subparsers(dest="command", required=True)

    def add(name: str, *options: str) -> argparse.ArgumentParser:
        c = commands.add_parser(name)
        c.add_argument("--data", default="data", help="folder with objects/, caves/ and relations/")
        c.add_argument("--generated-at", default=now())
        for o in ("valleys", "poland", "slovakia", "prefixes"):
            c.add_argument(f"--{o}", help="shapefiles without suffix, and the prefix configuration, for the resolver")
        c.add_argument("--prefix", help="one prefix for all points, instead of polygons")
        c.add_argument("--schemas", help="folder with {object,cave,relation}.schema.json; by default `schema` beside the data folder")
        for o in options:
            c.add_argument(f"--{o.rstrip('!')}", required=o.endswith("!"))
        return c

    add("validate", "root")
    add("build-db", "output!", "parquet")
    add("export", "output!")
    add("release", "output!")
    add("profile", "pig", "tpn", "output!")
    add("import-pig", "source!", "output!")
    add("import-tpn", "source!", "output!", "pig-staging")
    add("apply-review", "decisions!", "pig-staging", "tpn-staging", "output!", "reviewed-by").add_argument("--dry-run", action="store_true")
    c = add("assign-id")
    c.add_argument("--lat", type=float, required=True)
    c.add_argument("--lon", type=float, required=True)
    return p


def resolver_of(spark: SparkSession, a: argparse.Namespace) -> Resolver | None:
    if a.prefix:
        return constant_resolver(a.prefix)
    given = [a.valleys, a.poland, a.slovakia, a.prefixes]
    return polygon_resolver(load_polygons(spark, *given)) if all(given) else None


def schemas_of(a: argparse.Namespace) -> dict[str, dict] | None:
    """The schemas of the given folder, else those in `schema` beside the data folder, if there are any."""
    a.schemas = a.schemas or str(Path(a.data).resolve().parent / "schema")
    return {k: json.loads(p.read_text(encoding="utf-8")) for k in ("object", "cave", "relation") if (p := Path(a.schemas) / f"{k}.schema.json").exists()}


def files_of(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    """Paths of the files that attachments may name, below --root or else the folder that holds the data folder."""
    root = Path(getattr(a, "root", None) or Path(a.data).resolve().parent)
    found = []
    for folder, below, names in root.walk():
        below[:] = [d for d in below if d != ".git"]
        found += [(str((folder / n).relative_to(root)),) for n in names]
    return spark.createDataFrame(found, "file string")


def run(spark: SparkSession, a: argparse.Namespace) -> int:
    catalog = load_catalog(spark, a.data)
    resolver = resolver_of(spark, a)
    if a.command == "validate":
        issues = validate(catalog, resolver, schemas_of(a), files_of(spark, a)).persist()
        for row in formatted(issues).toLocalIterator():
            print(row.line)
        return int(has_errors(issues))
    if a.command in ("build-db", "export"):
        issues = require_valid(validate(catalog.check(), resolver, schemas_of(a), files_of(spark, a)).persist())
        if a.command == "build-db":
            print(release.build_snapshot(spark, catalog, issues, a.output, a.generated_at, a.parquet))
        else:
            print(*release.export_best_measurements(catalog, issues, a.output, a.generated_at), sep="\n")
        return 0
    if a.command == "release":
        print(*release.build_release(spark, catalog, a.output, a.generated_at, resolver, schemas_of(a), files_of(spark, a)).paths, sep="\n")
        return 0
    if a.command == "profile":
        print(*profiling.profile_sources(spark, {n: v for n, v in (("PIG", a.pig), ("TPN", a.tpn)) if v}, a.output, a.generated_at), sep="\n")
        return 0
    if a.command == "apply-review":
        data = review.read_decisions(spark, a.decisions)
        reports = {"PIG": staging.read_report(spark, a.pig_staging or "/nonexistent"), "TPN": staging.read_report(spark, a.tpn_staging or "/nonexistent")}
        found = review.review_file(spark, catalog, data, reports, a.generated_at, a.reviewed_by or "operator:staging-review")
        written = [] if a.dry_run else review.write_review(found, a.data)
        report = review.review_report(found, a.data, written)
        out = Path(a.output)
        out.mkdir(parents=True, exist_ok=True)
        (out / "staging-review.json").write_text(json.dumps(report, ensure_ascii=False, indent=2) + "\n", encoding="utf-8")
        lines = ["# Staging review", "", f"{report['decision_count']} applied, {report['issue_count']} issues.", ""]
        lines += staging.markdown_table(report["decisions"], ["decision_index", "action", "status", "object_id", "cave_id", "description"])
        lines += ["", *staging.markdown_table(report["issues"], ["decision_index", "severity", "code", "description"])]
        (out / "staging-review.md").write_text("\n".join(lines) + "\n", encoding="utf-8")
        return int(report["has_errors"])
    if resolver is None:
        raise SystemExit("this command needs polygons (--valleys --poland --slovakia --prefixes) or --prefix")
    if a.command == "assign-id":
        point = resolver(spark.createDataFrame([(0, a.lat, a.lon)], "point_id int, lat double, lon double"))
        seeds = staging.seeds_of(catalog.objects.select("path").where("path like '%.yml'"))
        row = point.join(seeds.withColumnRenamed("prefix", "p"), F.col("prefix") == F.col("p"), "left").select("status", "code", "message", "valley", numbered_id(F.col("prefix"), F.coalesce("seed", F.lit(0)) + 1).alias("id"), "prefix").first()
        print(row.id if row.prefix else f"{row.code}: {row.message}", row.valley or "", row.code or "", sep="\t")
        return int(row.prefix is None)
    table = read_source_table(spark, a.source)
    if a.command == "import-pig":
        found = staging.build_pig_staging(table, catalog, resolver, a.generated_at)
        print(*write_report(found, "pig", a.source, a.generated_at, a.output, "pig-staging", "PIG staging"), sep="\n")
        return 0
    stored = staging.read_report(spark, a.pig_staging) if a.pig_staging else None
    candidates = staged_candidates(stored["rows"], stored["proposed_objects"]) if stored else None
    found = staging.build_tpn_staging(table, catalog, resolver, a.generated_at, candidates)
    print(*write_report(found, "tpn", a.source, a.generated_at, a.output, "tpn-staging", "TPN staging"), sep="\n")
    return 0


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = SparkSession.getActiveSession() or build_session()
    try:
        return run(spark, args)
    except CatalogInvalidError as e:
        for i in e.issues:
            print(i.code, i.severity, i.path, i.description, sep="\t", file=sys.stderr)
        return 1
    except (CatalogLoadError, review.DecisionFileError, ValueError) as e:
        print(e, file=sys.stderr)
        return 1


if __name__ == "__main__":
    sys.exit(main())
