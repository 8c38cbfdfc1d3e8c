"""Union of table versions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame

from curatio.operators.columns import rename


def union_versions(
    frames: Sequence[DataFrame],
    renames: Sequence[Mapping[str, str] | None] | None = None,
    allow_missing: bool = False,
) -> DataFrame:
    """Align names of each version, then union all by name.

    ``allow_missing=False`` mirrors R's ``rbind``: differing column sets are
    an error.  One version is a valid degenerate union.
    """
    if not frames:
        raise ValueError("no versions to union")
    renames = list(renames or [None] * len(frames))
    aligned = [rename(f, r) if r else f for f, r in zip(frames, renames)]
    if not allow_missing:
        first = set(aligned[0].columns)
        for f in aligned[1:]:
            if set(f.columns) != first:
                raise ValueError(
                    f"versions differ in columns: {sorted(first ^ set(f.columns))}"
                )
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), aligned)
