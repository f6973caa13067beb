"""Where a load puts the tables it produces."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from layerforge.operators.delta import Stamp, read_watermark
from layerforge.sources.store import (
    APPEND,
    FOLD_LOADS,
    FOLD_SHARE,
    FULL,
    KEYED,
    VERSIONS,
    Loaded,
    TableStore,
)


class StoreSink:
    """Writes the tables of one load; later steps read the files, not the plans.

    A load that failed runs again under the same id: it starts from the state
    before itself, and nothing it wrote is visible before ``commit``.
    """

    def __init__(self, store: TableStore, load_id: str, load_ts: Stamp):
        self.store, self.load_id, self.load_ts = store, load_id, load_ts
        self._before = store.current(besides=load_id)
        self._written: dict[str, DataFrame] = {}
        self._loaded: dict[str, Loaded] = {}

    def mark(self, name: str) -> datetime:
        """Time of the last load of a table before this one, 1900-01-01 without any."""
        return read_watermark(self.store.log(besides=self.load_id), name)

    def known(self, name: str) -> bool:
        """Whether an earlier load wrote the table."""
        return name in self._before

    def get(self, name: str) -> DataFrame | None:
        """Table as written by this load, or as the loads before left it."""
        if name in self._written:
            return self._written[name]
        return self.before(name)

    def before(self, name: str) -> DataFrame | None:
        """Table as the loads before this one left it."""
        table = self._before.get(name)
        return None if table is None else self.store.open(name, table, besides=self.load_id)

    def put(self, name: str, df: DataFrame) -> DataFrame:
        """Whole table."""
        self.store.write(name, df, self.load_id)
        return self._note(name, FULL, df.schema)

    def append(self, name: str, added: DataFrame) -> DataFrame:
        """Rows that join those of earlier loads."""
        self.store.write(name, added, self.load_id)
        return self._note(name, APPEND, added.schema)

    def versions(self, name: str, changes: DataFrame, active: str) -> DataFrame:
        """Open rows and the rows closed by this load; rows closed before stay as they are."""
        self.store.write(name, changes, self.load_id, (active,))
        before = self._before.get(name)
        return self._note(name, VERSIONS, changes.schema, active, emptied=before and before.emptied)

    def replace(self, name: str, rows: DataFrame, active: str) -> DataFrame:
        """Versions of a table emptied first: no row of an earlier load is read any more.

        Like everything a load writes, it shows with ``commit``: until then, and if
        the load fails, readers have the table as it was.
        """
        self.store.write(name, rows, self.load_id, (active,))
        return self._note(name, VERSIONS, rows.schema, active, emptied=(str(self.load_ts), self.load_id))

    def upsert(self, name: str, delta: DataFrame, key: str) -> DataFrame:
        """Delete-insert by key: the staged rows are written, readers pass over what they replace.

        The whole table is written by the first load, and by one that finds a
        large share of it staged since.
        """
        if name not in self._before:
            return self._keyed(name, delta, key, whole=True)
        merged = self._keyed(name, delta, key, whole=False)
        loads = [*self.store.loads(name, besides=self.load_id), self._loaded[name]]
        since = sum(t.rows for t in loads[1:])
        if len(loads) <= FOLD_LOADS and since <= FOLD_SHARE * loads[0].rows:
            return merged
        return self._keyed(name, merged, key, whole=True)

    def _keyed(self, name: str, rows: DataFrame, key: str, whole: bool) -> DataFrame:
        n = self.store.write_keyed(name, rows, self.load_id, whole)
        return self._note(name, KEYED, rows.schema, key=key, rows=n, whole=whole)

    def _note(self, name: str, kind: str, schema: StructType, active: str | None = None, **more) -> DataFrame:
        self._loaded[name] = Loaded(self.load_id, kind, schema, active, **more)
        self._written[name] = self.store.open(name, self._loaded[name], besides=self.load_id)
        return self._written[name]

    def commit(self) -> None:
        self.store.commit(self._loaded, self.load_ts)
