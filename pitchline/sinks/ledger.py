"""What a run has done (N2): fingerprints of each dataset's inputs.

A dataset is noted with the fingerprint of the files it was built from when
its write is finished. A run that starts again skips the datasets whose
inputs are as they were, and builds the rest.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from pitchline.sinks import commits


def fingerprint(spark: SparkSession, paths: Sequence[str]) -> str:
    """Number and mixed names, sizes and times of all files under ``paths``
    (folders that exist); their content is not read, and no list of them
    passes through the driver."""
    parts = []
    for path in paths:
        if not commits.names(spark, path):
            parts.append("-")
            continue
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
        mixed = F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)"))
        row = files.select("path", "length", "modificationTime").agg(F.count(F.lit(1)).alias("n"), mixed.alias("h")).first()
        parts.append(f"{row['n']}:{row['h']}")
    return "|".join(parts)


def _log(root: str, layer: str, dataset: str) -> str:
    return f"{root.rstrip('/')}/_runs/{layer}/{dataset}"


def is_done(spark: SparkSession, root: str, layer: str, dataset: str, inputs: str) -> dict | None:
    """What was noted when the dataset was last built, if its inputs were these."""
    last = commits.newest(spark, _log(root, layer, dataset))
    return last if last and last["inputs"] == inputs else None


def note(spark: SparkSession, root: str, layer: str, dataset: str, inputs: str, **more) -> None:
    last = commits.newest(spark, _log(root, layer, dataset))
    try:
        commits.publish(spark, _log(root, layer, dataset), last["version"] + 1 if last else 0, {"inputs": inputs, **more})
    except commits.Conflict:  # another run noted it meanwhile; at worst it is built again
        pass
