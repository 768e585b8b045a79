"""Command line.

    python -m strandlake run CONFIG FOLDER [--demux-only]       # FASTQ to graded clones
    python -m strandlake rerun CONFIG FOLDER --source FOLDER --from STAGE
    python -m strandlake validate CONFIG                         # problems that a run would meet
    python -m strandlake layout CONFIG [--export FOLDER]         # the pooling layout as it is read
    python -m strandlake subsample INPUT OUTPUT --reads N [--anywhere SEED]
    python -m strandlake init FOLDER                             # a configuration to start from
    python -m strandlake doctor                                  # versions
"""

from __future__ import annotations

import argparse
import dataclasses
import gzip
import json
import platform
import sys
from pathlib import Path

from ..errors import StrandlakeError
from .config import PRESETS, load_config

EXAMPLE = """schema_version: 1
run_name: example
preset: inserts            # {presets}
inputs:
  - path: ${{READS}}/reads.fastq.gz
    sample_id: sample
libraries:
  library: references.fasta
plates: {{P1: AAAACCCCGGGG, P2: CCAATTGGAACC}}
wells: {{A1: ACGTACGTAACC, B1: TGCATGCATTGG}}
motifs: {{left: GATTACAGATT, right: CCGGAATTCCG}}
# layout: layout.csv       # plate_barcode,culture_plate,library,block,clonality
# flanks: {{library: {{derive: true, insert_thresholds: true}}}}
# chimera: {{min_depth: 6}}
export: true
"""


def doctor() -> dict:
    """Versions that a report of a problem needs."""
    import numpy
    import pandas
    import pyarrow
    import pyspark

    return {"python": platform.python_version(), "pyspark": pyspark.__version__, "pyarrow": pyarrow.__version__, "pandas": pandas.__version__, "numpy": numpy.__version__, "platform": platform.platform()}


def validate(spark, config) -> list[dict]:
    """Problems that a run would meet: close barcodes, unreadable references, routes to no library, a layout that plates, routes
    or references contradict. Nothing is written."""
    from ..operators import demux
    from ..sources.tables import TableError, read_libraries

    found = []
    for name, panel, call in (("plates", config.plates, config.plate_call), ("wells", config.wells, config.well_call)):
        if panel and call.policy == "best_margin":
            frame = spark.createDataFrame(sorted(panel.items()), "barcode_id string, sequence string")
            found += [{"problem": f"{name} too close", "subject": f"{r.a}/{r.b}"} for r in demux.unsafe_pairs(frame, call.max_edits, call.min_margin, call.both_strands).collect()]
    try:
        if config.libraries:
            read_libraries(spark, config.libraries)
    except TableError as error:
        found.append({"problem": "references", "subject": str(error)})
    found += [{"problem": "route to no library", "subject": p} for p, lib in sorted(config.routes.items()) if lib not in config.libraries]
    if config.layout is not None and not any(f["problem"] == "references" for f in found):
        found += layout_checks(spark, config)
    return found


def layout_checks(spark, config) -> list[dict]:
    """What a configuration's pooling layout says against its plates, routes and references, and pools that cannot be told apart."""
    from pyspark.sql import functions as F

    from ..functions.reads import block_of
    from ..operators import pooling
    from ..sources.tables import read_layout, read_libraries

    plan = read_layout(spark, config.layout).select("plate_id", "culture_plate", "library_id", "block")
    refs = read_libraries(spark, config.libraries).select("library_id", block_of(F.col("ref_id"), config.block_pattern).alias("block"))
    plates = spark.createDataFrame([(p,) for p in sorted(config.plates or {})], "barcode_id string")
    if config.routes or len(config.libraries) != 1:
        routes = spark.createDataFrame(sorted(config.routes.items()), "plate_id string, library_id string")
    else:  # without routes all plates are of the only library
        routes = plan.select("plate_id").distinct().withColumn("library_id", F.lit(next(iter(config.libraries))))
    told = pooling.layout_problems(plan, plates, routes, refs)
    told = told.union(pooling.pool_conflicts(plan.select("plate_id", "culture_plate").distinct(), plan.select("culture_plate", "library_id", "block").distinct()))
    return [{"problem": r.problem, "subject": r.subject} for r in told.orderBy("problem", "subject").collect()]


def subsample(source: str, target: str, reads: int, anywhere: int | None = None) -> int:
    """The first records of a local file, or records at random byte offsets of a plain one; returns how many were written."""
    from ..sources import fastq

    if Path(target).exists():
        raise ConfigExists(f"{target} is there already")
    if anywhere is not None:
        text = b"".join(body for _, body in fastq.offset_sample(source, reads, anywhere))
        n = reads
    else:
        lines, n = [], 0
        with open(source, "rb") as raw:
            for row in fastq.stream(raw, source, "0" * 64, allow_empty=True):
                lines.append(f"@{row[2]}\n{row[3]}\n+\n{row[4]}\n")
                n += 1
                if n == reads:
                    break
        text = "".join(lines).encode()
    with (gzip.open if target.endswith(".gz") else open)(target, "wb") as out:
        out.write(text)
    return n


class ConfigExists(StrandlakeError):
    """A file that would be overwritten."""


def init(folder: str) -> Path:
    """An example configuration in a folder; one that is there is left alone."""
    path = Path(folder) / "config.yaml"
    if path.exists():
        raise ConfigExists(f"{path} is there already")
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(EXAMPLE.format(presets=", ".join(sorted(PRESETS))), "utf-8")
    return path


def layout(spark, config, export: str | None = None) -> list[dict]:
    """The rows of a configuration's pooling layout; with export also as CSV."""
    from ..sources.tables import read_layout

    if config.layout is None:
        raise StrandlakeError("the configuration names no layout")
    rows = read_layout(spark, config.layout)
    if export:
        rows.orderBy("plate_id", "culture_plate", "library_id", "block").coalesce(1).write.option("header", True).csv(export)
    return [r.asDict() for r in rows.orderBy("plate_id", "culture_plate", "library_id", "block").toLocalIterator()]


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="strandlake", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    commands = top.add_subparsers(dest="command", required=True)

    def command(name: str, *positional: str) -> argparse.ArgumentParser:
        own = commands.add_parser(name)
        for p in positional:
            own.add_argument(p)
        return own

    first = command("run", "config", "folder")
    first.add_argument("--demux-only", action="store_true")
    again = command("rerun", "config", "folder")
    again.add_argument("--source", required=True)
    again.add_argument("--from", dest="stage", required=True)
    for own in (first, again):
        own.add_argument("--verify", action="store_true", help="keep checksums of tables, and compare those of tables taken again")
    command("validate", "config")
    command("layout", "config").add_argument("--export")
    sample = command("subsample", "input", "output")
    sample.add_argument("--reads", type=int, required=True)
    sample.add_argument("--anywhere", type=int)
    command("init", "folder")
    command("doctor")
    return top


def main(arguments: list[str] | None = None) -> int:
    given = parser().parse_args(arguments)
    try:
        return _run(given)
    except (StrandlakeError, OSError) as error:
        print(f"error: {error}", file=sys.stderr)
        return 2


def _run(given: argparse.Namespace) -> int:
    if given.command == "doctor":
        print(json.dumps(doctor(), indent=1))
        return 0
    if given.command == "init":
        print(init(given.folder))
        return 0
    if given.command == "subsample":
        print(subsample(given.input, given.output, given.reads, given.anywhere))
        return 0
    config = load_config(given.config)
    if getattr(given, "demux_only", False):
        config = dataclasses.replace(config, demux_only=True)
    from pyspark.sql import SparkSession

    from . import amplicon

    spark = SparkSession.builder.appName("strandlake").getOrCreate()
    if given.command == "layout":
        print(json.dumps(layout(spark, config, given.export), indent=1))
        return 0
    problems = validate(spark, config)
    print(json.dumps({"problems": problems}, indent=1))
    if problems or given.command == "validate":
        return int(bool(problems))
    if given.command == "rerun":
        out = amplicon.run(spark, config, given.folder, given.source, given.stage, verify=given.verify)
    else:
        out = amplicon.run(spark, config, given.folder, verify=given.verify)
    if "grades" in out:
        print(json.dumps([r.asDict() for r in out["grades"].orderBy("plate_id", "grade").collect()], indent=1))
    return 0
