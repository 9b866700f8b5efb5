"""Cached table reads, keyed by table and version."""

from __future__ import annotations

from collections import OrderedDict

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from stationflow.sources.snapshots import SnapshotTable


class TableCache:
    """Keeps the newest version of tables persisted, within a bound of file bytes.

    A frame is that of one version, so it is never stale: the next read after a commit finds another
    version and drops the frame of the older one.  The least recently read frames go when the bound is
    passed, and a table larger than the bound is read as it is.
    """

    def __init__(self, most_bytes: int = 1 << 30):
        self.most_bytes = most_bytes
        self.held: OrderedDict[str, tuple[int, int, DataFrame]] = OrderedDict()

    def read(self, table: SnapshotTable) -> DataFrame:
        snapshot = table.snapshot()
        version, size, frame = self.held.get(table.root, (0, 0, None))
        if frame is not None and version == snapshot.version:
            self.held.move_to_end(table.root)
            return frame
        self.drop(table.root)
        frame = table.read(snapshot.version)
        if snapshot.bytes > self.most_bytes:
            return frame
        while self.held and sum(h[1] for h in self.held.values()) + snapshot.bytes > self.most_bytes:
            self.drop(next(iter(self.held)))
        # Blocks that are lost or pushed out of memory are read from the files again or from disk.
        self.held[table.root] = (snapshot.version, snapshot.bytes, frame.persist(StorageLevel.MEMORY_AND_DISK))
        return self.held[table.root][2]

    def drop(self, root: str) -> None:
        if root in self.held:
            self.held.pop(root)[2].unpersist()
