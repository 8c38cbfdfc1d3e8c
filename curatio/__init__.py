"""curatio — cohort curation and sensor features as Spark DataFrame plans.

Sub-packages:

* ``sources``   — table scans, side lists, inline dimensions, attachment payloads.
* ``functions`` — column expressions (null-safe membership, JSON, rounding) and
  the domain rules (harmonisation, consistency codes, postcode generalisation).
* ``operators`` — DataFrame-to-DataFrame building blocks: projections, filters,
  null-safe joins, ordered aggregates, reshaping, windows, unions.
* ``plans``     — composed jobs: the standard curate pipeline, the trial-block
  summary, the baseline profile, attachment re-homing, publishing + lineage.
* ``sensors``   — per-recording series derivation and feature statistics,
  DFA, Lomb-Scargle, grouped FFT/ACF/EMD/EWT, and the named feature tables
  (``activities``: tapping, walking, rest; ``tremor``).
* ``streaming`` — the stateless curate steps applied to a streaming source.
* ``queries``   — the registered queries and their DuckDB oracles.

``python -m curatio`` runs the release jobs from the command line.
"""

from curatio.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
