"""The user-level jobs: one catalogue sync or one rights sync of a region.

Later steps read the tables that earlier ones wrote, so the steps run in waves;
the steps of a wave do not depend on each other and run side by side, which
keeps the cluster busy while one of them finishes its last tasks. Each changed
table is written once and read back, which cuts the lineage between waves; all
tables become visible together at the end, with the time up to which the region's
sources have been taken in. The next run goes back to that time if it lies before its
own window, so a run that did not happen loses no change.
"""

from __future__ import annotations

import threading
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import Region
from tidemark.plans import albums, artists, genres, rights, tracks, videos
from tidemark.plans.context import Run, Tables
from tidemark.sources.parallel import side_by_side
from tidemark.sources.settings import broadcasts_of
from tidemark.sources.snapshots import Folders, Part, Snapshots, Version


# Targets that steps of the catalogue sync look rows up in, whatever part they are in.
LOOKED_UP = ("artist", "album", "track", "genre", "style", "mv")
# Of files, which hold several times as much. A run has some hundred joins, and all that
# they broadcast passes through the driver.
BROADCAST = 1 << 20
RIGHTS = "ttmp_trackright"  # the source of a rights sync; all others belong to the catalogue


class _Session:
    """The targets of one run: as published, then as rewritten step by step.

    What steps read is noted, so that publishing can tell whether another run has
    changed it meanwhile: ``looked_up`` tables whole, others by part or region.
    """

    def __init__(self, store: Snapshots, looked_up: Sequence[str] = ()):
        self._store = store
        self._last, self._begun = store.published()
        self._folders = Version.of(self._begun)
        self._version = store.new_version(self._last + 1)
        self._written: list[tuple[Folders, bool]] = []
        self._read: set[tuple] = {(name,) for name in looked_up}
        self._lock = threading.Lock()  # steps of a wave put their tables side by side
        self.tables = store.read(self._folders)

    def earliest_mark(self, job: str, sources: Iterable[str]) -> datetime | None:
        """Up to when all of these sources have been taken in; None before the first run."""
        marks = self._begun.marks.get(job, {})
        known = [datetime.fromisoformat(marks[s]) for s in sources if s in marks]
        return min(known) if known else None

    def _note(self, name: str, parts: Iterable[tuple]) -> None:
        with self._lock:
            self._read |= {(name, *part) for part in parts}

    def narrow(self, target: DataFrame, name: str, rows: DataFrame) -> DataFrame:
        """What a change to the rows' ids needs of a table; a target cut down before stays."""
        if target is not self.tables[name]:
            return target
        return self._for_ids(name, self._store.parts_of(name, rows), rows)

    def narrow_in(self, name: str, rows: DataFrame, codes: list[str]) -> DataFrame:
        """What a change to the rows' ids in any of the regions needs of a region table."""
        return self._for_ids(name, self._store.parts_of(name, rows, codes), rows)

    def _for_ids(self, name: str, parts: set[Part], rows: DataFrame) -> DataFrame:
        self._note(name, parts)
        return self._store.read_for(name, self._now(), parts, rows)

    def _now(self) -> Version:
        with self._lock:
            return Version.of(self._folders)

    def of_region(self, name: str, code: str) -> DataFrame:
        """All parts of one region."""
        self._note(name, [(code,)])
        folders = self._now()
        parts = [(c, number) for table, c, number in folders if table == name and c == code]
        return self._store.read_table(name, folders, parts)

    def regions_of(self, name: str) -> set[str]:
        return {code for table, code, _ in self._now() if table == name}

    def put(self, name: str, df: DataFrame, before: DataFrame | None = None, whole: bool = False) -> None:
        """Write the parts a step has changed, unless it left the target as it was.

        ``whole`` says that ``df`` holds all rows of its parts; otherwise it holds those
        of the changed ids in hash buckets, which become changes beside their base.
        """
        if df is (self.tables[name] if before is None else before):
            return
        written = self._store.write(df, name, self._version)
        buckets = set() if whole else self._store.scattered((code, number) for _, code, number in written)
        beside = {key: path for key, path in written.items() if key[1:] in buckets}
        bases = {key: path for key, path in written.items() if key not in beside}
        with self._lock:
            for folders, is_change in ((bases, False), (beside, True)):
                self._folders.put(folders, is_change)
                self._written.append((folders, is_change))
            self.tables[name] = self._store.read_table(name, self._folders)

    def publish(self, job: str, sources: Iterable[str], as_of: datetime) -> dict[str, DataFrame]:
        """Make the run visible, on top of runs that have published meanwhile if they changed
        nothing that this one read or wrote. A run without changes moves the marks alone."""
        marks = {job: dict.fromkeys(sources, as_of.isoformat())}
        merged = self._store.publish_over(self._last, self._begun, self._written, self._read, marks)
        return self.tables if merged.differing(self._folders) == set() else self._store.read(merged)


def _job(region: Region) -> str:
    return region.code if region.regional else f"{region.code} generic"


@contextmanager
def _started(
    spark: SparkSession,
    store: Snapshots,
    region: Region,
    as_of: datetime,
    offset_days: float | None,
    sources: Iterable[str],
    looked_up: Sequence[str] = (),
) -> Iterator[tuple[_Session, Run]]:
    """The targets and settings of a run; its staged tables go at its end, failed or not."""
    to = _Session(store, looked_up)
    since = to.earliest_mark(_job(region), sources)
    run = Run.start(spark, region, as_of, offset_days, to.narrow, since)
    try:
        with broadcasts_of(spark, BROADCAST):
            yield to, run
    finally:
        run.stage.remove()


def sync_catalog(
    spark: SparkSession,
    src: Tables,
    store: Snapshots,
    region: Region,
    as_of: datetime,
    offset_days: float | None = None,
) -> dict[str, DataFrame]:
    """Bring every target up to date with the changes since the cut; returns the new targets.

    The cut is ``offset_days`` before ``as_of``, or the last run of this region if that was
    earlier.
    """
    sources = sorted(set(src) - {RIGHTS})
    with _started(spark, store, region, as_of, offset_days, sources, LOOKED_UP) as (to, run):
        _sync_catalog(spark, src, to, run)
        return to.publish(_job(region), sources, as_of)


def _sync_catalog(spark: SparkSession, src: Tables, to: _Session, run: Run) -> None:
    tgt, region = to.tables, run.region

    def genre_tree() -> None:
        if region.regional:
            to.put("genre", genres.sync_genre(src, tgt, run))
            to.put("style", genres.sync_style(src, tgt, run))

    def artist() -> None:
        to.put("artist", artists.sync_artist(src, tgt, run))

    def generic_album_ids() -> DataFrame | None:
        return None if region.regional else albums.changed_albums(src, run)

    _, _, album_ids, mv_ids, track_ids, album_styles = side_by_side(
        spark,
        genre_tree,
        artist,
        generic_album_ids,
        lambda: videos.changed_mvs(src, run),
        lambda: tracks.changed_tracks(src, run),
        lambda: albums.changed_album_styles(src, run),
    )

    def album_local() -> None:
        if not region.regional:
            to.put("album_local", albums.sync_album_local(src, tgt, run, album_ids))
            return
        # the status from rights concerns every album of the region; no other step
        # reads it, so it goes into the same write
        before = to.of_region("album_local", region.code)
        synced = albums.sync_album_local(src, tgt | {"album_local": before}, run)
        to.put("album_local", albums.album_status_by_rights(src, {"album_local": synced}, run), whole=True)

    def video() -> None:
        before = to.narrow(tgt["mv"], "mv", mv_ids)
        blinded = before
        if region.regional:
            blinded = videos.blind_deleted_mv(src, {"mv": before}, run)
        to.put("mv", videos.sync_mv(src, tgt | {"mv": blinded}, run, mv_ids), before)
        to.put("mv_local", videos.sync_mv_local(src, tgt, run, mv_ids))

    side_by_side(
        spark,
        lambda: to.put("artist_local", artists.sync_artist_local(src, tgt, run)),
        lambda: to.put("artist_style", artists.sync_artist_style(src, tgt, run)),
        lambda: to.put("album", albums.sync_album(src, tgt, run, album_ids)),
    )
    side_by_side(
        spark,
        album_local,
        lambda: to.put("album_style", albums.sync_album_style(src, tgt, run, album_styles)),
        lambda: to.put("track", tracks.sync_track(src, tgt, run, track_ids)),
    )
    side_by_side(
        spark,
        lambda: _put_track_local(to, src, run, track_ids),
        lambda: to.put("track_style", albums.sync_track_style(src, tgt, run, album_styles)),
        video,
    )


def _put_track_local(to: _Session, src: Tables, run: Run, ids: DataFrame) -> None:
    """Region rows and lyrics types in one write. Lyrics may change rows of other
    regions too; region codes are few."""
    types = tracks.lyric_types(src, run, ids)
    known = to.regions_of("track_local") | {run.region.code}
    sung = types.where(F.col("local_cd").isin(*known)).select("local_cd").distinct().collect()
    codes = sorted({run.region.code, *[r[0] for r in sung]})
    before = to.narrow_in("track_local", ids, codes)

    synced = tracks.sync_track_local(src, to.tables | {"track_local": before}, run, ids)
    if sung:
        synced = tracks.set_lyrics_type(synced, types)
    to.put("track_local", synced, before)


def sync_rights(
    spark: SparkSession,
    src: Tables,
    store: Snapshots,
    region: Region,
    as_of: datetime,
    offset_days: float | None = None,
) -> dict[str, DataFrame]:
    """Carry changed rights to the region's tracks and switch its albums on or off."""
    with _started(spark, store, region, as_of, offset_days, [RIGHTS]) as (to, run):
        tgt = to.tables
        album_local = {"album_local": to.of_region("album_local", region.code)}
        side_by_side(
            spark,
            lambda: to.put("track_local", rights.sync_track_rights(src, tgt, run)),
            lambda: to.put("album_local", albums.album_status_by_rights(src, album_local, run), whole=True),
        )
        return to.publish(_job(region), [RIGHTS], as_of)
