"""Versions of the target tables.

Plain parquet tables cannot be updated in place, so a run writes new folders and
publishes all of them at once with one small list of folders. Readers follow the
latest list: they see a whole run or nothing of it.

A table is kept in parts, by region code and by its id. A run reads and rewrites
only the parts that hold a changed id; all others keep their folder. New and
recently edited items have neighbouring ids, so that is a small share of a big
table. Ids beyond the ranges, and negative ones, fall into hash buckets, which
bounds the number of parts however the ids are scattered. How ids are dealt is
decided once per store and kept with its lists.

Scattered changes touch nearly every bucket, so a bucket is not rewritten: the rows of
the changed ids go to change files beside its base files. A reader leaves out the base
rows of ids that have changed (an anti-join on the ids) and adds their newest rows.
:meth:`Snapshots.fold` rewrites the buckets whose change files have grown beyond a
given share of the base.

Runs that start from one version may both publish when what one of them read or wrote
was not changed by the other: the later one puts its folders on top of the newest list.
The list also keeps up to when each region's sources have been taken in.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import asdict, dataclass
from functools import partial, reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from tidemark.schemas import PART_KEYS, REGION_TARGETS, TARGETS
from tidemark.sources.files import Files
from tidemark.sources.parallel import side_by_side
from tidemark.sources.settings import listing_tasks

Part = tuple[str, int]
Key = tuple[str, str, int]
Folders = Mapping[Key, str]
Marks = dict[str, dict[str, str]]

ALL_REGIONS = ""  # region code of a table without region rows
_CODE, _NUMBER, _AGE = "part_cd", "part_no", "__age"
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"  # folder name that Spark gives to NULL
_LISTING = 32  # tasks that list the folders of a table; each sends more to the driver than a folder's files take
_LIST = re.compile(r"run-(\d{10})\.json")


@dataclass(frozen=True)
class Layout:
    """Part numbers: -1 without an id, then ranges of ids from 0 on, then hash buckets."""

    ids_per_part: int = 10_000_000
    ranges: int = 4096
    buckets: int = 256

    def number(self, key: str) -> Column:
        ident = F.col(key)
        dense = (ident >= 0) & (ident < self.ids_per_part * self.ranges)
        ranged = F.expr(f"`{key}` div {self.ids_per_part}")
        hashed = F.lit(self.ranges) + F.pmod(F.xxhash64(ident), F.lit(self.buckets))
        return F.when(ident.isNull(), -1).when(dense, ranged).otherwise(hashed)


class Version(dict[Key, str]):
    """The base folder of every table part, the change folders beside it, and the marks.

    ``changes`` names the base that its folders belong to; with another base they are void.
    ``marks`` holds, by job and source, the time up to which changes have been taken in.
    """

    def __init__(
        self,
        folders: Folders | Iterable[tuple[Key, str]] = (),
        changes: Mapping[Key, tuple[str, tuple[str, ...]]] | None = None,
        marks: Marks | None = None,
    ):
        super().__init__(folders)
        self.changes = dict(changes or {})
        self.marks = {job: dict(sources) for job, sources in (marks or {}).items()}

    @classmethod
    def of(cls, folders: Folders) -> Version:
        if isinstance(folders, Version):
            return cls(folders, folders.changes, folders.marks)
        return cls(folders)

    def changes_of(self, key: Key) -> tuple[str, ...]:
        """Change folders of a part, oldest first."""
        base, found = self.changes.get(key, (None, ()))
        return found if self.get(key) == base else ()

    def put(self, written: Folders, beside: bool) -> None:
        """Take in new folders: as the base of their parts, or as changes where there is a base."""
        for key, path in written.items():
            if beside and key in self:
                self.changes[key] = self[key], (*self.changes_of(key), path)
            else:
                self[key] = path
                self.changes.pop(key, None)

    def move_marks(self, marks: Marks) -> None:
        for job, sources in marks.items():
            known = self.marks.setdefault(job, {})
            known.update({s: max(at, known.get(s, at)) for s, at in sources.items()})

    def paths(self) -> set[str]:
        return {*self.values(), *[p for key in self.changes for p in self.changes_of(key)]}

    def differing(self, other: Version) -> set[Key]:
        """Parts that are not the same in both."""
        return {k for k in {*self, *other} if (self.get(k), self.changes_of(k)) != (other.get(k), other.changes_of(k))}


class Snapshots:
    """The target tables under one root folder. Of several runs that start from one
    version the first to publish succeeds, and of the others those it did not affect.

    ``ids_per_part`` counts for a store without any version; an existing store keeps
    the layout it has.
    """

    def __init__(self, spark: SparkSession, root: str, ids_per_part: int = 10_000_000):
        self._spark = spark
        self._files = Files(spark)
        self._root = root.rstrip("/")
        self._new = Layout(ids_per_part)
        self._known: Layout | None = None

    def _runs(self) -> dict[int, str]:
        """The lists by run, from their names alone."""
        found = {n: _LIST.fullmatch(n) for n in self._files.names(f"{self._root}/published")}
        return {int(m[1]): f"{self._root}/published/{n}" for n, m in found.items() if m}

    def _list(self, path: str) -> tuple[Layout, Version]:
        content = json.loads(self._files.read(path))
        folders = {(t, code, number): p for t, code, number, p in content["parts"]}
        changes = {(t, code, number): (base, tuple(c)) for t, code, number, base, c in content.get("changes", ())}
        return Layout(**content["layout"]), Version(folders, changes, content.get("marks"))

    def published(self) -> tuple[int, Version]:
        """Number of the latest run and the folder of every table part.

        One entry per part, so small; no older list is read.
        """
        runs = self._runs()
        if not runs:
            return 0, Version()
        latest = max(runs)
        self._known, folders = self._list(runs[latest])
        return latest, folders

    @property
    def layout(self) -> Layout:
        if self._known is None:
            self.published()
        return self._known or self._new

    def read(self, folders: Folders) -> dict[str, DataFrame]:
        return {name: self.read_table(name, folders) for name in TARGETS}

    def read_table(self, name: str, folders: Folders, parts: Iterable[Part] | None = None) -> DataFrame:
        """A table, or only the given parts of it, with its changes folded in."""
        schema = TARGETS[name]
        wanted = None if parts is None else set(parts)
        version = Version.of(folders)
        plain: dict[str, list[str]] = {}
        changed: dict[str, list[Key]] = {}
        for key, path in sorted(folders.items()):
            table, code, number = key
            if table != name or wanted is not None and (code, number) not in wanted:
                continue
            if version.changes_of(key):
                changed.setdefault(code, []).append(key)
            else:
                plain.setdefault(code, []).append(path)
        reader = self._spark.read.schema(schema).option("recursiveFileLookup", "true")
        with listing_tasks(self._spark, _LISTING):
            found = [(code, reader.parquet(*paths)) for code, paths in plain.items()]
            found += [(code, self._folded(reader, version, keys, name)) for code, keys in changed.items()]
        regions = [
            # said as a literal, a filter on another region drops these files from the plan
            df.withColumn("local_cd", F.lit(code)) if name in REGION_TARGETS else df
            for code, df in found
        ]
        return reduce(DataFrame.unionAll, regions) if regions else self._spark.createDataFrame([], schema)

    def _folded(self, reader: DataFrameReader, version: Version, keys: list[Key], name: str) -> DataFrame:
        """Parts of one region with changes: the newest rows of each changed id, other ids as in the base.

        The change files' sizes are known, so Spark streams the base past few changed ids
        and sort-merges it with many.
        """
        key = PART_KEYS[name]
        ages: dict[int, list[str]] = {}
        for part in keys:
            for age, path in enumerate(version.changes_of(part)):
                ages.setdefault(age, []).append(path)
        rows = [reader.parquet(*paths).withColumn(_AGE, F.lit(age)) for age, paths in ages.items()]
        changes = reduce(DataFrame.unionAll, rows)
        if len(ages) > 1:
            newest = changes.groupBy(key).agg(F.max(_AGE).alias(_AGE))
            changes = changes.join(newest, [key, _AGE], "left_semi")
        base = reader.parquet(*[version[part] for part in keys])
        return base.join(changes.select(key), key, "left_anti").unionByName(changes.drop(_AGE))

    def scattered(self, parts: Iterable[Part]) -> set[Part]:
        """Those of the parts that are hash buckets."""
        return {part for part in parts if part[1] >= self.layout.ranges}

    def read_for(self, name: str, folders: Folders, parts: Iterable[Part], ids: DataFrame) -> DataFrame:
        """What a change to ``ids`` needs of a table: parts by range whole, of hash buckets the rows of these ids."""
        buckets = self.scattered(parts)
        ranges = set(parts) - buckets
        some = []
        if ranges or not buckets:
            some.append(self.read_table(name, folders, ranges))
        if buckets:
            key = PART_KEYS[name]
            some.append(self.read_table(name, folders, buckets).join(ids.select(key), key, "left_semi").select(*TARGETS[name].names))
        return reduce(DataFrame.unionAll, some)

    def _part_columns(self, name: str) -> dict[str, Column]:
        code = F.col("local_cd") if name in REGION_TARGETS else F.lit(ALL_REGIONS)
        number = self.layout.number(PART_KEYS[name]) if name in PART_KEYS else F.lit(0)
        return {_CODE: code, _NUMBER: number.cast("long")}

    def parts_of(self, name: str, rows: DataFrame, codes: Iterable[str] | None = None) -> set[Part]:
        """The parts that rows with a table's key columns belong to.

        With ``codes``, the rows have no region and count for each of these. The layout
        bounds the numbers, so they are few.
        """
        columns = [c.alias(n) for n, c in self._part_columns(name).items() if codes is None or n != _CODE]
        found = rows.select(*columns).distinct().collect()
        if codes is None:
            return {(r[_CODE], r[_NUMBER]) for r in found}
        return {(code, r[_NUMBER]) for r in found for code in codes}

    def new_version(self, run: int) -> str:
        """Folder name of one attempt at a run; a failed attempt does not block the next."""
        return f"{run}-{uuid.uuid4().hex[:8]}"

    def write(self, df: DataFrame, name: str, version: str) -> Folders:
        """Write the next version of the parts that ``df`` holds whole."""
        split = self._part_columns(name)
        by = [_CODE, _NUMBER] if name in REGION_TARGETS else [_NUMBER]
        path = f"{self._root}/versions/{version}/{name}"
        rows = df.withColumns({c: split[c] for c in by})
        # a part's rows meet in a few files, unless it is so big that they are split again
        rows.hint("rebalance", *by).write.partitionBy(*by).parquet(path)
        found = [path]
        for column in by:
            found = [f"{f}/{n}" for f in found for n in self._files.names(f) if n.startswith(f"{column}=")]
        folders = {}
        for folder in found:
            values = dict(step.split("=", 1) for step in folder[len(path) + 1 :].split("/"))
            code = values.get(_CODE, ALL_REGIONS)
            if code == _NO_VALUE:
                raise ValueError(f"{name} has rows without a region")
            folders[name, unquote(code), int(values[_NUMBER])] = folder
        return folders

    def publish(self, folders: Mapping[tuple[str, str, int], str], run: int) -> None:
        """Make a run visible: its list appears whole under the run's number, or not at all
        if another run took the number."""
        version = Version.of(folders)
        changes = [[*key, version[key], version.changes_of(key)] for key in sorted(version.changes) if version.changes_of(key)]
        content = {
            "layout": asdict(self.layout),
            "parts": [[*part, path] for part, path in sorted(folders.items())],
            "changes": changes,
            "marks": version.marks,
        }
        if not self._files.create(f"{self._root}/published/run-{run:010d}.json", json.dumps(content)):
            raise FileExistsError(f"run {run} of {self._root} is published already")

    def publish_over(
        self,
        run: int,
        begun: Version,
        written: Iterable[tuple[Folders, bool]],
        read: Iterable[tuple],
        marks: Marks | None = None,
    ) -> Version:
        """Publish what a run wrote on top of run ``run``, from which it began, or of the newest
        one if no run in between changed what this one read or wrote.

        ``written`` pairs new folders with whether they are changes beside a base. ``read``
        names tables, regions of a table or single parts, as (table,), (table, code) or
        (table, code, number).
        """
        written, read = list(written), set(read)
        own = {key for folders, _ in written for key in folders}
        latest = begun
        while True:
            merged = Version.of(latest)
            for folders, beside in written:
                merged.put(folders, beside)
            merged.move_marks(marks or {})
            try:
                self.publish(merged, run + 1)
                return merged
            except FileExistsError:
                run, latest = self.published()
                for key in sorted(begun.differing(latest)):
                    if key in own or any(key[:n] in read for n in (1, 2, 3)):
                        raise FileExistsError(f"another run has changed part {key} of {self._root}") from None

    def fold(self, ratio: float = 0.1) -> set[Key]:
        """Rewrite the parts whose change files take more than ``ratio`` of the base's bytes.

        Readers of older lists keep their files; a run that is under way and has read one
        of these parts fails to publish, and the other way round.
        """
        run, now = self.published()
        due = {
            key
            for key in now.changes
            if (changes := now.changes_of(key)) and sum(map(self._files.size, changes)) > ratio * self._files.size(now[key])
        }
        version = self.new_version(run + 1)
        written = []
        for name in sorted({key[0] for key in due}):
            parts = [key[1:] for key in due if key[0] == name]
            written.append((self.write(self.read_table(name, now, parts), name, version), False))
        if due:
            self.publish_over(run, now, written, due)
        return due

    def seed(self, tables: Mapping[str, DataFrame]) -> None:
        """Publish given tables as the next version."""
        run, folders = self.published()
        version = self.new_version(run + 1)
        steps = [partial(self.write, df, name, version) for name, df in tables.items()]
        for written in side_by_side(self._spark, *steps):
            folders.update(written)
        self.publish(folders, run + 1)

    def remove_unused(self, keep_runs: int) -> None:
        """Forget all but the latest runs, and the folders that none of those uses.

        To be called while no run writes and no reader uses a run that goes.
        """
        if keep_runs < 1:
            raise ValueError("the latest run stays")
        runs = self._runs()
        kept = sorted(runs)[-keep_runs:]
        used = {path for run in kept for path in self._list(runs[run])[1].paths()}
        for run in set(runs) - set(kept):
            self._files.remove(runs[run])
        versions = f"{self._root}/versions"
        for version in self._files.names(versions):
            for name in self._files.names(f"{versions}/{version}"):
                self._remove_unused(f"{versions}/{version}/{name}", used)

    def _remove_unused(self, folder: str, used: set[str]) -> None:
        if not any(path == folder or path.startswith(f"{folder}/") for path in used):
            self._files.remove(folder)
        elif folder not in used:
            for name in self._files.names(folder):
                if "=" in name:
                    self._remove_unused(f"{folder}/{name}", used)
