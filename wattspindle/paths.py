"""Where the layers live."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class LakePaths:
    """Folder layout under one root, local or an object-store URI."""

    root: str

    def layer(self, layer: str, dataset: str) -> str:
        return "/".join([self.root.rstrip("/"), layer, dataset])

    def bronze(self, dataset: str = "telemetry") -> str:
        return self.layer("bronze", dataset)

    def silver(self, dataset: str = "harmonized") -> str:
        return self.layer("silver", dataset)

    def mart(self, dataset: str) -> str:
        return self.layer("mart", dataset)

    def checkpoint(self, query: str) -> str:
        return self.layer("checkpoints", query)

    def ledger(self) -> str:
        return self.layer("ledger", "runs")
