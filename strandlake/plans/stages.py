"""Stages as written tables that are taken again while nothing they depend on has changed.

A stage's fingerprint is a digest of its name, parameters, the fingerprints before it
and the package's own source, so changed code is never taken for the same run. Its table
is written beside its final place and renamed when complete; a manifest holds
fingerprint, schema, row count and the size of each file, with verify also checksums
that tasks tell. A manifest with another fingerprint refuses the folder instead of mixing runs, and so does
a table whose files are not those of its manifest. A stage that fails leaves a note of
the error beside its place, until it succeeds. A run may inherit stages of an earlier one: those before
a named stage, and only if their fingerprints are what this run would give them. Paths
go through Hadoop's file systems, so any store that Spark opens will do.
"""

from __future__ import annotations

import ast
import hashlib
import importlib
import json
import pkgutil
import uuid
from collections.abc import Callable
from dataclasses import asdict, is_dataclass
from functools import cache

from pyspark.sql import DataFrame, SparkSession

from ..errors import StrandlakeError
from ..sources.fastq import file_digests, listed


class StageError(StrandlakeError, RuntimeError):
    """A stage whose folder holds something else than it should."""


def canonical_json(value) -> str:
    def plain(x):
        if is_dataclass(x):
            return plain(asdict(x))
        if isinstance(x, dict):
            return {str(k): plain(v) for k, v in x.items()}
        if isinstance(x, (set, frozenset)):
            return sorted((plain(v) for v in x), key=repr)
        return [plain(v) for v in x] if isinstance(x, (list, tuple)) else x

    return json.dumps(plain(value), sort_keys=True, separators=(",", ":"), allow_nan=False)


def digest(value) -> str:
    return hashlib.sha256(canonical_json(value).encode()).hexdigest()


#: The subpackages that a run's results depend on.
PARTS = ("functions", "operators", "plans", "sources")


@cache
def implementation() -> str:
    """Digest of what the code of a run says: the syntax trees of its modules, so comments and layout do not count."""
    package = __package__.rpartition(".")[0]
    total = hashlib.sha256()
    for part in PARTS:
        own = importlib.import_module(f"{package}.{part}")
        for module in sorted(pkgutil.iter_modules(own.__path__), key=lambda m: m.name):
            source = module.module_finder.find_spec(module.name).loader.get_source(module.name)
            total.update(f"{part}.{module.name}\n{ast.dump(ast.parse(source))}\n".encode())
    return total.hexdigest()


class Stages:
    """The stages of one run below a folder; with source, stages before recompute_from come from that run's folder."""

    def __init__(self, spark: SparkSession, folder: str, source: str | None = None, recompute_from: str | None = None, order: tuple[str, ...] = (), verify: bool = False):
        self.verify = verify
        self.spark, self.folder = spark, folder.rstrip("/")
        self.source = source.rstrip("/") if source else None
        if source and recompute_from not in order:
            raise StageError(f"no stage {recompute_from}; stages are {', '.join(order)}")
        self.inherits = set(order[: order.index(recompute_from)]) if source else set()
        self.reused: list[str] = []
        self.wrote: list[str] = []
        self.inherited: list[str] = []

    def _path(self, name: str, folder: str | None = None):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{folder or self.folder}/{name}")

    def _files(self, name: str, folder: str | None = None):
        return self._path(name, folder).getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())

    def _manifest(self, name: str, folder: str | None = None) -> dict | None:
        if not self._files(name, folder).exists(self._path(f"{name}.manifest", folder)):
            return None
        return json.loads("".join(r[0] for r in self.spark.read.text(f"{folder or self.folder}/{name}.manifest").collect()))

    def _note(self, name: str, content: dict) -> None:
        self._say(f"{name}.manifest", content)

    def _say(self, name: str, content: dict) -> None:
        self.spark.createDataFrame([(canonical_json(content),)], "value string").coalesce(1).write.mode("overwrite").text(f"{self.folder}/{name}")

    def table(self, name: str, depends: dict, build: Callable[[], DataFrame]) -> DataFrame:
        """The stage's table: as written before if its fingerprint is the same, else built and written."""
        mark = digest({"stage": name, "depends": depends, "implementation": implementation()})
        known = self._manifest(name)
        target = f"{self.folder}/{name}"
        if known is not None:
            if known["fingerprint"] != mark:
                raise StageError(f"stage {name} was written with other inputs, parameters or code; use another folder")
            self.reused.append(name)
            return self._checked(name, known, known.get("at", target))
        if name in self.inherits:
            earlier = self._manifest(name, self.source)
            if earlier is None or earlier["fingerprint"] != mark:
                raise StageError(f"stage {name} cannot be inherited: the earlier run {'has none' if earlier is None else 'made it with other inputs, parameters or code'}")
            at = earlier.get("at", f"{self.source}/{name}")
            self._note(name, earlier | {"at": at})
            self.inherited.append(name)
            return self._checked(name, earlier, at)
        temporary, files = f"{name}.{uuid.uuid4().hex}", self._files(name)
        try:
            frame = build()
            frame.write.parquet(f"{self.folder}/{temporary}")
            if not files.rename(self._path(temporary), self._path(name)):
                raise StageError(f"stage {name} has a folder without a manifest")
        except Exception as error:
            files.delete(self._path(temporary), True)
            self._say(f"{name}.failed", {"stage": name, "error": type(error).__name__, "says": str(error)[:2000]})
            raise
        files.delete(self._path(f"{name}.failed"), True)
        out = self.spark.read.schema(frame.schema).parquet(target)
        self._note(name, {"stage": name, "fingerprint": mark, "rows": out.count(), "schema": frame.schema.simpleString(), "files": self._sizes(target), "checksums": self._checksums(target) if self.verify else None})
        self.wrote.append(name)
        return out

    def _sizes(self, at: str) -> dict[str, int]:
        """Size of each data file of a table."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(at)
        store = path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
        return {f.getPath().getName(): f.getLen() for f in store.listStatus(path) if not f.getPath().getName().startswith(("_", "."))}

    def _checksums(self, at: str) -> dict[str, str]:
        return {name.rsplit("/", 1)[-1]: told for name, (told, _) in file_digests(self.spark, listed(self.spark, at)).items()} if self._sizes(at) else {}

    def _checked(self, name: str, manifest: dict, at: str) -> DataFrame:
        """A table as its manifest describes it."""
        if "files" in manifest and manifest["files"] != self._sizes(at):
            raise StageError(f"stage {name}: the files of {at} are not those that were written")
        if self.verify and manifest.get("checksums") is None:
            raise StageError(f"stage {name} was written without checksums")
        if self.verify and manifest["checksums"] != self._checksums(at):
            raise StageError(f"stage {name}: a file of {at} has changed since it was written")
        return self.spark.read.parquet(at)

    def fingerprint(self, name: str) -> str:
        known = self._manifest(name)
        if known is None:
            raise StageError(f"stage {name} is not written")
        return known["fingerprint"]
