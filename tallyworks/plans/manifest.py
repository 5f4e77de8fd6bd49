"""What a run has finished, so that the same run can go on after a failure.

Each stage leaves a line with what it measured and a fingerprint: of the stage's inputs, the options of the run and
the stages before. A later run in the same folder skips the stages whose fingerprint is the same, up to the first that differs
or is missing.
"""

from __future__ import annotations

import hashlib
import json
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from tallyworks.sources import files, hadoop

SCHEMA = "fingerprint string, saved string"


def chained(*parts: object) -> str:
    """A digest of everything that a stage depends on."""
    return hashlib.sha256("|".join(map(str, parts)).encode()).hexdigest()


def inputs_state(*inputs: DataFrame) -> str | None:
    """A digest of the files behind all inputs; ``None`` if one of them does not come from files."""
    states = [hadoop.state_of_inputs(df) for df in inputs]
    return None if None in states else chained(*states)


class Manifest:
    """The finished stages of a run's folder."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, f"{folder}/manifest"

    def saved(self, stage: str, fingerprint: str) -> dict[str, Any] | None:
        """What the stage saved when it was finished with this fingerprint."""
        path = f"{self.folder}/{stage}"
        if not hadoop.exists(self.spark, f"{path}/_SUCCESS"):
            return None
        line = self.spark.read.schema(SCHEMA).json(path).first()
        return json.loads(line["saved"]) if line and line["fingerprint"] == fingerprint else None

    def clear(self) -> None:
        """Forget all stages."""
        hadoop.delete(self.spark, self.folder)

    def begin(self, stage: str) -> None:
        """Forget the stage: what it wrote is about to be replaced."""
        hadoop.delete(self.spark, f"{self.folder}/{stage}")

    def finish(self, stage: str, fingerprint: str, saved: dict[str, Any]) -> None:
        line = files.few_rows(self.spark, [(fingerprint, json.dumps(saved))], SCHEMA)
        files.write_json_summary(line, f"{self.folder}/{stage}")
