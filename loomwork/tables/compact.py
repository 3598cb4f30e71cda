"""Few files of a stated size: small files of a folder are rewritten together."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import SparkSession

from loomwork.tables.files import File, Store

TARGET_BYTES = 256 << 20
PENDING = "_compaction.json"


def plan(files: Sequence[File], target_bytes: int) -> list[list[File]]:
    """Groups of files to rewrite as one: first fit, largest first, in bins of ``target_bytes``.

    Files of three quarters of the target or more are left alone, and so are
    files that end up by themselves.
    """
    small = sorted((f for f in files if 4 * f.size < 3 * target_bytes), key=lambda f: (-f.size, f.path))
    bins: list[tuple[int, list[File]]] = []
    for file in small:
        for i, (size, members) in enumerate(bins):
            if size + file.size <= target_bytes:
                members.append(file)
                bins[i] = (size + file.size, members)
                break
        else:
            bins.append((file.size, [file]))
    return [members for _, members in bins if len(members) > 1]


def compact_files(spark: SparkSession, path: str, target_bytes: int = TARGET_BYTES, fmt: str = "parquet") -> int:
    """Rewrite small files of a folder into files of about ``target_bytes``; returns how many were replaced.

    Files are joined only within their own folder, so partitions stay.  Groups
    are written in one job, one task per group, into a hidden folder; a note
    names the old and the new files before any is moved.  A run that dies after
    the note is finished by the next one, one that dies before it has changed
    nothing; readers during the swap may miss rows, as with any overwrite in place.
    """
    store = Store(spark, path)
    _finish(store)
    folders: dict[str, list[File]] = {}
    for file in store.files():
        folders.setdefault(file.path.rsplit("/", 1)[0], []).append(file)
    groups = [(folder, g) for folder, files in sorted(folders.items()) for g in plan(files, target_bytes)]
    if not groups:
        return 0
    aside = f"_compacting-{uuid.uuid4().hex}"
    for number, (_, group) in enumerate(groups):
        # Its bytes are at most the target, so a group is the work of one task.
        rows = spark.read.format(fmt).load([f.path for f in group]).coalesce(1)
        rows.write.format(fmt).save(f"{store.path}/{aside}/{number}")
    moves, old = [], []
    for number, (folder, group) in enumerate(groups):
        for name in store.names(f"{aside}/{number}"):
            if not name.startswith(("_", ".")):
                moves.append([f"{aside}/{number}/{name}", f"{folder}/{name}"])
        old += [f.path for f in group]
    store.create(PENDING, json.dumps({"old": old, "moves": moves, "aside": aside}))
    _finish(store)
    return len(old)


def _finish(store: Store) -> None:
    """Carry out the swap that the note describes, from wherever it stopped."""
    if not store.exists(PENDING):
        return
    told = json.loads(store.read(PENDING))
    for file in told["old"]:
        store.delete(file)
    for source, target in told["moves"]:
        if store.exists(source):
            store.move(source, target)
    store.delete(told["aside"])
    store.delete(PENDING)
