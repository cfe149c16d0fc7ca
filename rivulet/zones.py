"""Where each layer lives below one root."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Zones:
    """Folders of one pipeline. Every streaming query has a checkpoint of its own."""

    root: str
    name: str = "transactions"

    def _path(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    @property
    def landing(self) -> str:
        return self._path("in", self.name)

    @property
    def topic_log(self) -> str:
        return self._path("topic", self.name)

    @property
    def bronze(self) -> str:
        return self._path("raw", self.name)

    @property
    def silver(self) -> str:
        return self._path("processed", self.name)

    @property
    def bronze_failed(self) -> str:
        return self._path("dlq", "raw", self.name)

    @property
    def malformed(self) -> str:
        return self._path("dlq", "processed", f"{self.name}_malformed")

    @property
    def rejected(self) -> str:
        return self._path("dlq", "processed", f"{self.name}_rejected")

    @property
    def failed_batches(self) -> str:
        return self._path("dlq", "processed", f"{self.name}_failed_batches")

    @property
    def outcomes(self) -> str:
        return self._path("outcomes", self.name)

    def isolation(self, source: str) -> str:
        """Where a failing batch lies while its bad messages are looked for."""
        return self._path("work", self.name, f"isolation-{source}")

    def checkpoint(self, job: str) -> str:
        return self._path("checkpoint", job, self.name)
