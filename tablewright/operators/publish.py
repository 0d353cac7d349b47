"""Write, audit, publish: new data reaches the published branch only if every gate is silent."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from tablewright.operators.gates import Blocked, require_clean, run_gates
from tablewright.sources.snapshots import SnapshotStore


def write_audit_publish(
    store: SnapshotStore,
    branch: str,
    target: str,
    tables: dict[str, DataFrame],
    gates: Callable[[SnapshotStore, str], list],
    metadata: dict[str, str] | None = None,
) -> tuple[str, DataFrame]:
    """Stage ``tables`` on a new branch, audit what was written, then merge or stop.

    Returns ("published", findings) or ("blocked", findings). The audit reads the staged files, not
    the frames that produced them; a blocked branch stays for inspection.
    """
    store.create_branch(branch, target)
    for name, df in tables.items():
        store.overwrite(branch, name, df, f"stage {name}", metadata=metadata)
    found = run_gates(gates(store, branch))
    try:
        require_clean(found)
    except Blocked:
        return "blocked", found
    store.merge(branch, target)
    return "published", found
