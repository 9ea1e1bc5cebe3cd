"""Ingestion contracts: JSON documents that say which source goes into which table, and how.

Two kinds are told apart by what they name. A landing contract has a source path and format
(S1) and fills a Bronze table; a promotion contract names the Bronze table's contract
as its source and fills a Silver table by a strategy with keys and a watermark column (K6). Both
carry an ``enabled`` switch (E6), the audit columns to add, and paths of table contracts,
relative to themselves. :func:`plan` reads a folder of them into the specs that
:class:`~refinery.plans.pipeline.SalesPipeline` runs, so a new source needs a document, not code.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from pathlib import Path

from refinery.contracts import Contract, resolve
from refinery.plans.pipeline import IngestionSpec, SalesPipeline

# What an ingestion contract may ask for.
INGEST_TYPES = ("batch",)
LOAD_TYPES = ("full", "incremental")
FORMATS = ("json",)
STRATEGIES = ("full_merge",)
AUDIT = {"add_ingested_at": "_ingested_at", "add_ingested_date": "_ingested_date",
         "add_source_file": "_source_file", "add_silver_timestamps": "_silver_modified_at"}


class IngestionError(ValueError):
    pass


@dataclass(frozen=True)
class IngestionContract:
    name: str
    enabled: bool
    load_type: str
    destination: Contract
    source_path: str = ""
    options: dict = field(default_factory=dict)
    source: Contract | None = None
    merge_keys: tuple[str, ...] = ()
    watermark: str = ""
    audit: tuple[str, ...] = ()

    @property
    def promotes(self) -> bool:
        return self.source is not None

    @classmethod
    def load(cls, path: str | Path, config: dict | None = None) -> "IngestionContract":
        """Read and check one document; every fault names the file and what is wrong."""
        path = Path(path)
        text = path.read_text(encoding="utf-8")
        try:
            doc = json.loads(resolve(text, config) if config else text)
        except (json.JSONDecodeError, KeyError) as exc:
            raise IngestionError(f"{path.name}: {exc}") from exc

        def table(key: str) -> Contract:
            target = (path.parent / doc[key]).resolve()
            if not target.exists():
                raise IngestionError(f"{path.name}: {key} {doc[key]} does not exist")
            return Contract.load(target, config)

        def one_of(key: str, allowed: tuple, value) -> None:
            if value not in allowed:
                raise IngestionError(f"{path.name}: {key} {value!r} is none of {allowed}")

        for key in ("name", "destination_contract"):
            if key not in doc:
                raise IngestionError(f"{path.name}: lacks {key}")
        one_of("ingest_type", INGEST_TYPES, doc.get("ingest_type", "batch"))
        one_of("load_type", LOAD_TYPES, doc.get("load_type", "full"))
        source, destination = doc.get("source", {}), table("destination_contract")
        audit = tuple(AUDIT[k] for k, on in doc.get("metadata", {}).items() if on and k in AUDIT)
        lacking = [c for c in audit if c not in destination.names]
        if lacking:
            raise IngestionError(f"{path.name}: {destination.full_name} does not declare audit columns {lacking}")
        common = dict(name=doc["name"], enabled=bool(doc.get("enabled", True)),
                      load_type=doc.get("load_type", "full"), destination=destination, audit=audit)
        if "source_contract" not in doc:
            one_of("format", FORMATS, source.get("format"))
            if not source.get("path"):
                raise IngestionError(f"{path.name}: lacks source.path")
            return cls(**common, source_path=source["path"], options=dict(source.get("options", {})))
        one_of("strategy", STRATEGIES, doc.get("strategy"))
        origin, keys, watermark = table("source_contract"), tuple(doc.get("merge_keys", ())), doc.get("watermark_col", "")
        wrong = [c for c in (*keys, watermark) if c not in origin.names]
        if not keys or wrong:
            raise IngestionError(f"{path.name}: merge_keys and watermark_col must be columns of {origin.full_name}, "
                                 f"got {list(keys)} and {watermark!r}")
        return cls(**common, source=origin, merge_keys=keys, watermark=watermark)

    def spec(self) -> IngestionSpec:
        """What the pipeline runs. The landing's schema is the destination's without audit columns."""
        if self.promotes:
            return IngestionSpec(self.name, "", self.source, self.destination, enabled=self.enabled,
                                 merge_keys=self.merge_keys, order=(self.watermark,))
        landing = Contract(name=f"{self.destination.name}_landing", format="json", catalog="landing",
                           schema_name=self.destination.schema_name,
                           columns=tuple(c for c in self.destination.columns if c.name not in AUDIT.values()))
        return IngestionSpec(self.name, self.source_path, landing, self.destination, enabled=self.enabled,
                             options=self.options)


def plan(folder: str | Path, config: dict | None = None) -> list[IngestionContract]:
    """All ingestion contracts below ``folder`` (``*.json``), landing ones first, by name."""
    found = [IngestionContract.load(p, config) for p in sorted(Path(folder).rglob("*.json"))]
    targets = [c.destination.full_name for c in found]
    twice = {t for t in targets if targets.count(t) > 1}
    if twice:
        raise IngestionError(f"more than one ingestion contract fills {sorted(twice)}")
    return sorted(found, key=lambda c: (c.promotes, c.name))


def pipeline_from(spark, root: str, folder: str | Path, config: dict | None = None) -> SalesPipeline:
    """A pipeline whose specs come from the ingestion contracts of ``folder`` alone.

    ``{path.landing}`` and the like in the documents come from ``config``.
    """
    p = SalesPipeline(spark, root)
    contracts = plan(folder, config)
    p.bronze_specs = [c.spec() for c in contracts if not c.promotes]
    p.silver_specs = [c.spec() for c in contracts if c.promotes]
    return p
