"""Places of the lake's zones and the choice of gold tables."""

from __future__ import annotations

from dataclasses import dataclass, field

# Zones of the lake and gold tables, with the partition column of those that have one.
ZONES = ["landing", "bronze", "silver", "gold", "quarantine", "quality"]
GOLD = {"sessions": "partition_date", "funnel_daily": "partition_date", "orders": "partition_date", "customer_rfm": None, "product_daily": "partition_date", "anomalies": "partition_date"}
# Older configuration keys of a zone's or dataset's prefix, and of its whole path.
LEGACY_PREFIX = {"gold": "CURATED_PREFIX", "bronze/events": "RAW_PREFIX", "silver/events": "PROCESSED_PREFIX", "quarantine/events": "REJECTED_PREFIX"}
LEGACY_PATH = {"bronze/events": "RAW_S3_PATH", "silver/events": "PROCESSED_S3_PATH"}


@dataclass
class Lake:
    """root with zones below it; overrides gives other places, e.g. {"gold/orders": "s3://..."}."""

    root: str
    overrides: dict[str, str] = field(default_factory=dict)

    @classmethod
    def from_config(cls, config: dict[str, str]) -> Lake:
        """A lake by configuration: OUTPUT_BUCKET, ZONE_PREFIX, ZONE_DATASET_PREFIX and ZONE_DATASET_S3_PATH keys, and the older names of some."""
        root = f"s3://{config['OUTPUT_BUCKET']}"
        places = {}
        for name in [*ZONES, *LEGACY_PREFIX, *[f"gold/{t}" for t in GOLD]]:
            key = name.upper().replace("/", "_")
            whole = next((config[k] for k in (f"{key}_S3_PATH", LEGACY_PATH.get(name)) if k and config.get(k)), None)
            prefix = next((config[k] for k in (f"{key}_PREFIX", LEGACY_PREFIX.get(name)) if k and config.get(k) is not None), None)
            if whole or prefix is not None:
                places[name] = whole or f"{root}/{prefix.strip().strip('/')}"
        return cls(root, {n: p.rstrip("/") for n, p in places.items()})

    def path(self, zone: str, *dataset: str) -> str:
        if zone not in ZONES:
            raise ValueError(f"no zone {zone}")
        name = "/".join([zone, *dataset])
        for depth in range(len(name.split("/")), 0, -1):
            head = "/".join(name.split("/")[:depth])
            if head in self.overrides:
                return self.overrides[head].rstrip("/") + name[len(head) :]
        return f"{self.root.rstrip('/')}/{name}"


def gold_tables(chosen: list[str] | None = None) -> list[str]:
    """All tables for None, none for an empty list; unknown names are an error."""
    if chosen is None:
        return list(GOLD)
    if unknown := set(chosen) - set(GOLD):
        raise ValueError(f"unknown gold tables: {sorted(unknown)}")
    return list(chosen)
