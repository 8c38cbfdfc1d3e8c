"""One release job end to end, as each reference script runs it.

scan versions -> standard curate (filters first) -> re-home attachment
handles of the *released* rows -> choice-answer cells to document handles
-> typed projection with a conformance check -> payload and document stores,
table, one provenance row.

When a release writes more than the table (payloads, documents), the
curated rows are computed once and cut with a reliable ``checkpoint()``
into the cluster's shared ``spark.checkpoint.dir``, so the input scan and
anti joins are not repeated per output.  The stores are addressed by content and
filled before the table that names their handles; a rerun adds nothing to them.
Each write is an atomic Spark job; a lost executor only re-runs tasks.
``release_set`` publishes several jobs' tables as one version by the manifest.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from curatio.operators.columns import HANDLE_KIND, project_to_schema
from curatio.plans.attachments import (
    choice_documents, one_new, rehome, replace_choice_cell, store_documents, store_payloads, substitute_handles, used_handles,
)
from curatio.plans.curate import RAW_COLUMN, TableSpec, curate
from curatio.plans.manifest import publish_set
from curatio.plans.publish import append_provenance, provenance_with_count, publish
from curatio.session import checkpoint_dir


@dataclass
class ReleaseOutputs:
    table: str
    payloads: str | None
    documents: str | None
    provenance: str


def released_frame(
    spec: TableSpec,
    frames: Mapping[str, DataFrame],
    excluded: DataFrame,
    withdrew: DataFrame,
    attachments: DataFrame | None = None,
    handle_columns: tuple[str, ...] = (),
    target: T.StructType | None = None,
    curated: DataFrame | None = None,
    mapping: DataFrame | None = None,
    **kw,
) -> DataFrame:
    """The release table as a lazy DataFrame (no writes).

    ``mapping``: old handle -> new, where it is known already.
    """
    out = curated if curated is not None else curate(spec, frames, excluded, withdrew, **kw)
    handles = [h for h in handle_columns if h in out.columns]
    if attachments is not None and handles:
        out = substitute_handles(out, rehome(attachments, used_handles(out, handles)) if mapping is None else mapping, handles)
    for col in spec.json_columns:
        if col in out.columns:
            out = replace_choice_cell(out, col)
    if target is not None:
        drop = [d for d in (spec.schema_drop or [*spec.drop, RAW_COLUMN]) if d not in spec.json_columns]
        fields = [f for f in target.fields if f.name not in spec.json_columns]
        fields += [T.StructField(j, T.StringType(), True, HANDLE_KIND) for j in spec.json_columns if j in out.columns]
        out = project_to_schema(out, T.StructType(fields), drop)
    return out


def release(
    spec: TableSpec,
    frames: Mapping[str, DataFrame],
    excluded: DataFrame,
    withdrew: DataFrame,
    outputs: ReleaseOutputs,
    attachments: DataFrame | None = None,
    handle_columns: tuple[str, ...] = (),
    target: T.StructType | None = None,
    executed: str | None = None,
    as_of=None,
    **kw,
) -> DataFrame:
    """Write the release table, its payloads and its lineage row; return the table as read back."""
    table = _with_stores(spec, frames, excluded, withdrew, outputs, attachments, handle_columns, target, **kw)
    publish(table, outputs.table)
    back = table.sparkSession.read.parquet(outputs.table)
    append_provenance(provenance_with_count(back, spec.name, spec.used, executed, as_of), outputs.provenance)
    return back


@dataclass
class ReleaseJob:
    """One table of ``release_set``: its spec and inputs, as ``release`` takes them."""

    spec: TableSpec
    frames: Mapping[str, DataFrame]
    attachments: DataFrame | None = None
    handle_columns: tuple[str, ...] = ()
    target: T.StructType | None = None


def release_set(
    jobs: Mapping[str, ReleaseJob],
    excluded: DataFrame,
    withdrew: DataFrame,
    root: str,
    run: str,
    executed: str | None = None,
    as_of=None,
    **kw,
) -> DataFrame:
    """Several tables as one version under ``root``; return their manifest rows.

    Payloads and documents go to the stores ``files`` and ``documents`` there,
    which all versions share.  Read the tables with ``manifest.read_current``.
    """
    stores = ReleaseOutputs("", f"{root}/files", f"{root}/documents", "")
    tables = {name: _with_stores(j.spec, j.frames, excluded, withdrew, stores, j.attachments, j.handle_columns, j.target, **kw)
              for name, j in jobs.items()}
    return publish_set(excluded.sparkSession, root, run, tables, {name: j.spec.used for name, j in jobs.items()}, executed, as_of)


def _with_stores(
    spec: TableSpec,
    frames: Mapping[str, DataFrame],
    excluded: DataFrame,
    withdrew: DataFrame,
    outputs: ReleaseOutputs,
    attachments: DataFrame | None,
    handle_columns: tuple[str, ...],
    target: T.StructType | None,
    **kw,
) -> DataFrame:
    """The release table, after its payloads and documents have gone to their stores."""
    curated = curate(spec, frames, excluded, withdrew, **kw)
    several = (attachments is not None and handle_columns and outputs.payloads) or (
        spec.json_columns and outputs.documents)
    if several:
        checkpoint_dir(curated.sparkSession)  # an error without a shared folder
        curated = curated.checkpoint(eager=True)
    mapping = None
    handles = [h for h in handle_columns if h in curated.columns]
    if attachments is not None and handles:
        used = used_handles(curated, handles)
        if outputs.payloads:
            mapping, _ = store_payloads(attachments, used, outputs.payloads)
        else:
            mapping = one_new(rehome(attachments, used))
    if spec.json_columns and outputs.documents:
        docs = [choice_documents(curated, col).select("handle", "document") for col in spec.json_columns if col in curated.columns]
        if docs:
            store_documents(reduce(DataFrame.unionByName, docs), outputs.documents)
    return released_frame(spec, frames, excluded, withdrew, attachments, handle_columns, target, curated=curated, mapping=mapping)
