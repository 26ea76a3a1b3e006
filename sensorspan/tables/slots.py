"""A table in slots (days, hash buckets) of which a merge rewrites only those it touches.

Layout: ``slot=S/version=N/`` holds a slot as of version N, ``commits/version=N`` says
that all slots of version N are written. A slot is read in its newest version. Merging
the same version again, after a crash, reads what was held before it and gives the same.

``Parts`` are slots that a merge does not rewrite whole; ``parts/slot=S/version=N/part=M-K/`` says
that version N of slot S holds what K merges from version M on have brought.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.dedupe import newest_per_key
from ..operators.tables import empty_relation
from . import storage

SLOT = "slot"
VERSION = "version"


class Slots:
    """Rows of ``schema`` under ``root``. One writer at a time; versions ascend.

    Files are of the given ``kind``. ``inner`` columns become folders inside a slot's
    version, ``arrange`` deals out and sorts the rows before they are written.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schema: T.StructType,
        kind: str = "parquet",
        options: dict[str, str] | None = None,
        inner: Sequence[str] = (),
        arrange: Callable[[DataFrame], DataFrame] | None = None,
    ):
        self.spark = spark
        self.root = root
        self.schema = schema
        self.kind = kind
        self.options = options or {}
        self.inner = inner
        self.arrange = arrange or (lambda rows: rows.hint("rebalance", SLOT))

    def versions(self) -> list[int]:
        names = storage.children(self.spark, f"{self.root}/commits")
        return sorted(int(name.split("=")[1]) for name in names)

    def _newest(self, upto: int | None, without: Collection[int], slots: Collection[str] | None = None) -> dict[str, int]:
        """The version to read of each slot: the newest committed one up to ``upto``, not in ``without``."""
        good = {v for v in self.versions() if (upto is None or v <= upto) and v not in without}
        found: dict[str, int] = {}
        for path in storage.matches(self.spark, f"{self.root}/{SLOT}=*/{VERSION}=*"):
            slot, version = (part.split("=", 1)[1] for part in path.split("/")[-2:])
            if int(version) in good and (slots is None or slot in slots):
                found[slot] = max(found.get(slot, -1), int(version))
        return found

    def _folders(self, chosen: dict[str, int]) -> DataFrame:
        return self._files(sorted(chosen.items())).select(*self.schema.names)

    def _files(self, chosen: Collection[tuple[str, int]]) -> DataFrame:
        """The rows of some versions of slots, with both."""
        kinds = T.StructType([*self.schema.fields, T.StructField(SLOT, T.StringType()), T.StructField(VERSION, T.LongType())])
        if not chosen:
            return empty_relation(self.spark, kinds)
        paths = [f"{self.root}/{SLOT}={slot}/{VERSION}={version}" for slot, version in chosen]
        reader = self.spark.read.schema(kinds).options(**self.options).option("basePath", self.root)
        return reader.format(self.kind).load(paths)

    def slots(self) -> set[str]:
        """All slots that were ever written."""
        return {p.rsplit("=", 1)[1] for p in storage.matches(self.spark, f"{self.root}/{SLOT}=*")}

    def folder(self, slot: str) -> str | None:
        """Where the newest version of a slot is; None if it has none."""
        found = self._newest(None, (), {slot})
        return f"{self.root}/{SLOT}={slot}/{VERSION}={found[slot]}" if found else None

    def folders(self, slots: Collection[str] | None = None) -> dict[str, int]:
        """How many folders the newest version of each slot has; they are counted, slot by slot, and not kept."""
        chosen = self._newest(None, (), slots)
        return {slot: storage.count(self.spark, f"{self.root}/{SLOT}={slot}/{VERSION}={v}") for slot, v in chosen.items()}

    def read(self, upto: int | None = None, without: Collection[int] = (), slots: Collection[str] | None = None) -> DataFrame:
        """The rows as of a version; ``slots`` opens only those."""
        return self._folders(self._newest(upto, without, slots))

    def merge(
        self,
        version: int,
        changed: DataFrame,
        combine: Callable[[DataFrame, DataFrame], DataFrame],
        without: Collection[int] = (),
        keep: int = 2,
        publish: bool = True,
    ) -> set[str]:
        """Bring ``changed`` (the columns and ``slot``, a text that can stand in a path) in as ``version``.

        ``combine`` makes the new rows of the touched slots from their held and their changed
        ones, and has to give the columns and ``slot``. Versions that ``keep`` newer ones of a slot follow go.
        A merge in steps over slots does not ``publish`` its steps, but all the slots they return at the end.
        """
        changed = changed.persist()  # read for its slots, then for its rows
        touched = {row[0] for row in changed.select(SLOT).distinct().collect()}
        held = self._folders(self._newest(version - 1, without, touched))
        self._put(version, combine(held, changed), touched)
        if publish:
            self.publish(version, touched, without, keep)
        changed.unpersist()
        return touched

    def publish(self, version: int, touched: Collection[str], without: Collection[int] = (), keep: int = 2) -> None:
        """Make a version of some slots visible that is written."""
        storage.make(self.spark, f"{self.root}/commits/{VERSION}={version}")
        self._forget(touched, without, keep)

    def discard(self, version: int) -> None:
        """What a merge that died has left of a version that was not published goes, whatever slots it touched."""
        for path in storage.matches(self.spark, f"{self.root}/{SLOT}=*/{VERSION}={version}"):
            storage.delete(self.spark, path)

    def replace(self, version: int, rows: DataFrame, slots: Collection[str], without: Collection[int] = (), keep: int = 2) -> None:
        """Put ``rows`` in the place of what ``slots``, and those of the rows, hold."""
        rows = rows.persist()
        touched = {*slots, *(row[0] for row in rows.select(SLOT).distinct().collect())}
        self._write(version, rows, touched, without, keep)
        rows.unpersist()

    def _write(self, version: int, rows: DataFrame, touched: set[str], without: Collection[int], keep: int) -> None:
        self._put(version, rows, touched)
        self.publish(version, touched, without, keep)

    def _put(self, version: int, rows: DataFrame, touched: set[str]) -> None:
        if touched:
            # What a merge that died has left of this version goes first. The version counts once it is in
            # ``commits``, so each task may move its own files into place and the driver moves none.
            for slot in touched:
                storage.delete(self.spark, f"{self.root}/{SLOT}={slot}/{VERSION}={version}")
            (
                self.arrange(rows.withColumn(VERSION, F.lit(version).cast("long")))
                .write.mode("append")
                .format(self.kind)
                .options(**self.options)
                .option("mapreduce.fileoutputcommitter.algorithm.version", "2")
                .partitionBy(SLOT, VERSION, *self.inner)
                .save(self.root)
            )
        for slot in touched:  # one without rows is an empty folder
            storage.make(self.spark, f"{self.root}/{SLOT}={slot}/{VERSION}={version}")

    def _forget(self, slots: Collection[str], dead: Collection[int], keep: int) -> None:
        versions: dict[str, list[tuple[int, str]]] = {}
        for path in storage.matches(self.spark, f"{self.root}/{SLOT}=*/{VERSION}=*"):
            slot, version = (part.split("=", 1)[1] for part in path.split("/")[-2:])
            if slot in slots:
                versions.setdefault(slot, []).append((int(version), path))
        for found in versions.values():
            good = sorted(item for item in found if item[0] not in dead)
            for _, path in [*good[:-keep], *(item for item in found if item[0] in dead)]:
                storage.delete(self.spark, path)


class Parts(Slots):
    """Slots in which a row replaces older ones with the same ``keys``, and a merge rewrites only small parts.

    A slot consists of several versions, its parts. A merge takes in those that stand for no more merges than
    what it has taken in so far, like the digits of a binary counter, so a slot that many merges touch is
    rewritten in proportion to the logarithm of their number. Readers take each key's newest row. A version
    without a note of its part is the whole slot.
    """

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, keys: Sequence[str]):
        super().__init__(spark, root, schema)
        self.keys = tuple(keys)

    def _parts(self, upto: int | None, without: Collection[int], slots: Collection[str] | None = None) -> dict[str, list[tuple[int, int, int]]]:
        """The parts of each slot, newest first: version, first version and number of merges."""
        good = {v for v in self.versions() if (upto is None or v <= upto) and v not in without}
        noted: dict[tuple[str, int], tuple[int, int]] = {}
        for path in storage.matches(self.spark, f"{self.root}/parts/{SLOT}=*/{VERSION}=*/part=*"):
            slot, version, part = (piece.split("=", 1)[1] for piece in path.split("/")[-3:])
            first, merges = part.split("-")
            noted[slot, int(version)] = int(first), int(merges)
        found: dict[str, list[int]] = {}
        for path in storage.matches(self.spark, f"{self.root}/{SLOT}=*/{VERSION}=*"):
            slot, version = (piece.split("=", 1)[1] for piece in path.split("/")[-2:])
            if int(version) in good and (slots is None or slot in slots):
                found.setdefault(slot, []).append(int(version))
        chosen: dict[str, list[tuple[int, int, int]]] = {}
        for slot, versions in found.items():
            parts = chosen.setdefault(slot, [])
            for version in sorted(versions, reverse=True):
                if not parts or version < parts[-1][1]:
                    parts.append((version, *noted.get((slot, version), (min(versions), 1 << 62))))
        return chosen

    def _latest(self, rows: DataFrame) -> DataFrame:
        return newest_per_key(rows, self.keys, [VERSION])

    def read(self, upto: int | None = None, without: Collection[int] = (), slots: Collection[str] | None = None) -> DataFrame:
        parts = self._parts(upto, without, slots)
        whole = self._files([(slot, own[0][0]) for slot, own in sorted(parts.items()) if len(own) == 1])
        several = [(slot, part[0]) for slot, own in sorted(parts.items()) if len(own) > 1 for part in own]
        rows = whole.unionByName(self._latest(self._files(several))) if several else whole
        return rows.select(*self.schema.names)

    def merge(self, version: int, changed: DataFrame, without: Collection[int] = (), keep: int = 2) -> None:
        """Bring in ``changed`` (the columns and ``slot``), which has each key once, as ``version``."""
        changed = changed.persist()  # read for its slots, then for its rows
        touched = {row[0] for row in changed.select(SLOT).distinct().collect()}
        held = self._parts(version - 1, without, touched)
        joined: list[tuple[str, int]] = []
        notes: dict[str, str] = {}
        for slot in touched:
            first, merges = version, 1
            for older, since, number in held.get(slot, ()):
                if number > merges:
                    break
                joined.append((slot, older))
                first, merges = since, merges + number
            notes[slot] = f"{first}-{merges}"
        rows = changed.select(*self.schema.names, SLOT)
        if joined:
            own = rows.withColumn(VERSION, F.lit(version).cast("long"))
            rows = self._latest(self._files(sorted(joined)).unionByName(own)).drop(VERSION)
        for slot, part in notes.items():  # a note counts for nothing before its version is committed
            storage.delete(self.spark, f"{self.root}/parts/{SLOT}={slot}/{VERSION}={version}")
            storage.make(self.spark, f"{self.root}/parts/{SLOT}={slot}/{VERSION}={version}/part={part}")
        self._write(version, rows, touched, without, keep)
        changed.unpersist()

    def replace(self, version: int, rows: DataFrame, slots: Collection[str], without: Collection[int] = (), keep: int = 2) -> None:
        raise NotImplementedError("parts are merged only")

    def _forget(self, slots: Collection[str], dead: Collection[int], keep: int) -> None:
        """Versions that are no part as of the ``keep`` newest ones go, and versions of merges that died."""
        good = [v for v in self.versions() if v not in dead]
        used = {(slot, part[0]) for v in good[-keep:] for slot, parts in self._parts(v, dead, slots).items() for part in parts}
        for path in storage.matches(self.spark, f"{self.root}/{SLOT}=*/{VERSION}=*"):
            slot, version = (piece.split("=", 1)[1] for piece in path.split("/")[-2:])
            if slot in slots and (slot, int(version)) not in used and (int(version) in good or int(version) in dead):
                storage.delete(self.spark, path)
                storage.delete(self.spark, f"{self.root}/parts/{SLOT}={slot}/{VERSION}={version}")
