"""Audit columns: when a row was built and by which run."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martweave.functions.calendar import moment


@dataclass(frozen=True)
class Run:
    """One run of the build: one id and one clock for every row it writes."""

    run_id: str = field(default_factory=lambda: uuid.uuid4().hex)
    loaded_at: datetime | None = None

    def stamp(self, df: DataFrame) -> DataFrame:
        """Set (never pass on) the audit columns; each layer has its own."""
        clock = F.current_timestamp() if self.loaded_at is None else moment(self.loaded_at)
        return df.withColumns({"_loaded_at": clock, "_run_id": F.lit(self.run_id)})
