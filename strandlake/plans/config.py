"""Run configuration: a closed YAML schema with presets and environment names."""

from __future__ import annotations

import os
import re
from dataclasses import dataclass, field, fields
from pathlib import Path

from ..errors import StrandlakeError
from ..operators.assign import AssignSettings
from ..operators.chimera import ChimeraSettings
from ..operators.consensus import ConsensusSettings
from ..operators.demux import CallSettings, Gates
from ..operators.flanks import ANCHOR
from ..operators.motifs import MotifPair
from ..operators.qc import QcSettings


class ConfigError(StrandlakeError, ValueError):
    """A configuration that breaks the schema."""


@dataclass(frozen=True)
class FlankSettings:
    """Where a full-length library's constant regions come from: stated, an example construct, or what its references share."""

    upstream: str | None = None
    downstream: str | None = None
    template: str | None = None
    derive: bool = False
    anchor_length: int = ANCHOR
    max_edits: int = 2
    insert_thresholds: bool = False

    def __post_init__(self) -> None:
        if (self.upstream is None) != (self.downstream is None) or [self.upstream is not None, self.template is not None, self.derive].count(True) != 1:
            raise ValueError("flanks are two sequences, or a template, or derived")
        if self.anchor_length < 1 or self.max_edits < 0:
            raise ValueError("an anchor has a base or more, edits are not negative")


@dataclass(frozen=True)
class RunConfig:
    """Everything a run depends on."""

    run_name: str
    inputs: tuple[tuple[str, str], ...]  # path, sample_id
    libraries: dict[str, list[str]] = field(default_factory=dict)
    routes: dict[str, str] = field(default_factory=dict)
    gates: Gates = Gates()
    allow_empty: bool = False
    plates: dict[str, str] | None = None
    wells: dict[str, str] | None = None
    plate_call: CallSettings = CallSettings()
    well_call: CallSettings = CallSettings()
    motifs: MotifPair | None = None
    assign: AssignSettings = AssignSettings()
    consensus: ConsensusSettings = ConsensusSettings()
    qc: QcSettings = QcSettings()
    demux_only: bool = False
    chimera: ChimeraSettings | None = None
    layout: str | None = None
    block_pattern: str = r"^Block_(\d+)_"
    flanks: dict[str, FlankSettings] = field(default_factory=dict)
    export: bool = False


NAME = re.compile(r"\$\{([A-Za-z_][A-Za-z0-9_]*)\}")
#: Keys of each section and the field they set.
SECTIONS = {
    "gates": (Gates, {"min_length", "max_length", "min_quality"}),
    "assign": (AssignSettings, {f.name for f in fields(AssignSettings)}),
    "consensus": (ConsensusSettings, {f.name for f in fields(ConsensusSettings)}),
    "qc": (QcSettings, {f.name for f in fields(QcSettings)}),
    "chimera": (ChimeraSettings, {f.name for f in fields(ChimeraSettings)}),
    "motifs": (MotifPair, {f.name for f in fields(MotifPair)}),
    "plate_call": (CallSettings, {f.name for f in fields(CallSettings)}),
    "well_call": (CallSettings, {f.name for f in fields(CallSettings)}),
}
KNOWN = {"schema_version", "run_name", "inputs", "libraries", "routes", "allow_empty", "plates", "wells", "demux_only", "preset", "layout", "block_pattern", "flanks", "export", *SECTIONS}
#: Tuning that a configuration may start from by name.
PRESETS: dict[str, dict] = {
    "inserts": {
        "gates": {"min_length": 200, "max_length": 3000, "min_quality": 10},
        "plate_call": {"window": 120, "max_edits": 3, "min_margin": 2}, "well_call": {"window": 160, "max_edits": 3, "min_margin": 2},
        "assign": {"kmer_sizes": [15, 11, 9], "rescue": "kmer"}, "consensus": {"min_depth": 3, "max_reads": 100},
    },
    "full-length": {
        "gates": {"min_length": 500, "max_length": 6000, "min_quality": 10},
        "plate_call": {"window": 200, "max_edits": 3, "min_margin": 2}, "well_call": {"window": 240, "max_edits": 3, "min_margin": 2},
        "assign": {"kmer_sizes": [21, 15, 11], "max_kmer_owners": 10, "rescue": "kmer"}, "consensus": {"min_depth": 5, "max_reads": 200},
    },
}


def expanded(value, environment: dict[str, str]):
    """Values with ${NAME} replaced; an unset name is an error."""
    if isinstance(value, dict):
        return {k: expanded(v, environment) for k, v in value.items()}
    if isinstance(value, list):
        return [expanded(v, environment) for v in value]
    if not isinstance(value, str):
        return value
    missing = [n for n in NAME.findall(value) if n not in environment]
    if missing:
        raise ConfigError(f"environment names that are not set: {', '.join(missing)}")
    return NAME.sub(lambda m: environment[m[1]], value)


def merged(base: dict, over: dict) -> dict:
    """over on top of base, section by section."""
    out = dict(base)
    for k, v in over.items():
        out[k] = merged(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else v
    return out


def _section(name: str, given: dict):
    kind, keys = SECTIONS[name]
    if not isinstance(given, dict) or set(given) - keys:
        raise ConfigError(f"{name}: unknown {', '.join(sorted(set(given) - keys)) if isinstance(given, dict) else 'section'}")
    try:
        return kind(**{k: tuple(v) if isinstance(v, list) else v for k, v in given.items()})
    except (TypeError, ValueError) as error:
        raise ConfigError(f"{name}: {error}") from error


def parse_config(given: dict, presets: dict[str, dict] | None = None, environment: dict[str, str] | None = None) -> RunConfig:
    raw = expanded(given, environment if environment is not None else dict(os.environ))
    if "preset" in raw:
        known = PRESETS | (presets or {})
        if raw["preset"] not in known:
            raise ConfigError(f"no preset {raw['preset']}; there are {', '.join(sorted(known))}")
        raw = merged(known[raw["preset"]], raw)
    if set(raw) - KNOWN:
        raise ConfigError(f"unknown keys: {', '.join(sorted(set(raw) - KNOWN))}")
    if raw.get("schema_version") != 1:
        raise ConfigError("schema_version is 1")
    inputs = tuple((str(i["path"]), str(i["sample_id"])) for i in raw.get("inputs") or ())
    if not inputs or len({s for _, s in inputs}) < len(inputs):
        raise ConfigError("inputs have a path and a sample_id of their own")
    demux_only = bool(raw.get("demux_only", False))
    libraries = {k: [v] if isinstance(v, str) else list(v) for k, v in (raw.get("libraries") or {}).items()}
    if not libraries and not demux_only:
        raise ConfigError("libraries name the references")
    for name in ("plates", "wells"):
        for barcode, seq in (raw.get(name) or {}).items():
            if not re.fullmatch("[ACGTRYSWKMBDHVN]+", str(seq)):
                raise ConfigError(f"{name}: {barcode} is not a sequence")
    flanks = {}
    for library, own in (raw.get("flanks") or {}).items():
        if library not in libraries:
            raise ConfigError(f"flanks of {library}, which is no library")
        try:
            flanks[library] = FlankSettings(**own)
        except (TypeError, ValueError) as error:
            raise ConfigError(f"flanks of {library}: {error}") from error
    sections = {k: _section(k, raw[k]) for k in SECTIONS if raw.get(k) is not None}
    return RunConfig(str(raw.get("run_name", "run")), inputs, libraries, dict(raw.get("routes") or {}), allow_empty=bool(raw.get("allow_empty", False)), plates=raw.get("plates"), wells=raw.get("wells"), demux_only=demux_only, layout=raw.get("layout"), block_pattern=str(raw.get("block_pattern", RunConfig.block_pattern)), flanks=flanks, export=bool(raw.get("export", False)), **sections)


def load_config(path: str, presets: dict[str, dict] | None = None) -> RunConfig:
    import yaml

    given = yaml.safe_load(Path(path).read_text("utf-8"))
    if not isinstance(given, dict):
        raise ConfigError("a configuration is a mapping")
    return parse_config(given, presets)
