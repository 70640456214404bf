"""Versions of the events table: which files hold which days.

A merge writes its files to a folder of its own, ``commit=<id>/event_date=<day>``,
and then one commit record that names all files of the new version. Readers take
the files of the newest record, so they see a version whole or not at all, and a
reader that has opened one keeps it while later merges go on. The record of a
version is created once: of two writers that start from one version the second
fails with :class:`VersionTaken` and leaves the table as it is.

A record also tells which days its merge changed, so that jobs can recompute
exactly those. It lists files, not rows, and the driver holds it whole.
"""

from __future__ import annotations

import datetime as dt
import json
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from authwatch.sources import files
from authwatch.sources.files import DataFile

LOG, FOLDER = "_commits", "commit"


class VersionTaken(RuntimeError):
    """Another writer has made the next version."""


def as_text(day: dt.date | None) -> str | None:
    return None if day is None else day.isoformat()


@dataclass(frozen=True)
class Snapshot:
    """One version of a table; version 0 is the table without files."""

    path: str
    version: int = 0
    files: dict[str, int] = field(default_factory=dict)  # relative path: bytes
    days: tuple[str | None, ...] = ()  # the days that this version changed
    rejects: dict[str, int] = field(default_factory=dict)  # values its merge left out

    def of_days(self, days) -> list[DataFile]:
        """Files of some days, given as texts."""
        found = (DataFile(f"{self.path}/{name}", size) for name, size in self.files.items())
        return [f for f in found if f.part("event_date") in days]

    def stored_days(self) -> set[str | None]:
        return {DataFile(name, 0).part("event_date") for name in self.files}


def _name(version: int) -> str:
    return f"{version:020d}.json"


def _load(spark: SparkSession, path: str, version: int) -> Snapshot:
    record = json.loads(files.read_text(spark, f"{path}/{LOG}/{_name(version)}"))
    return Snapshot(path, version, record["files"], tuple(record["days"]),
                    record["rejects"])


def versions(spark: SparkSession, path: str) -> list[int]:
    return [int(name.removesuffix(".json")) for name in files.names(spark, f"{path}/{LOG}")
            if name.endswith(".json")]


def newest(spark: SparkSession, path: str) -> Snapshot:
    known = versions(spark, path)
    return _load(spark, path, known[-1]) if known else Snapshot(path)


def at_version(spark: SparkSession, path: str, version: int) -> Snapshot:
    return _load(spark, path, version) if version else Snapshot(path)


def commit(spark: SparkSession, base: Snapshot, added: str, replaced, days,
           rejects: dict[str, int]) -> Snapshot:
    """The version after ``base``: the files below folder ``added`` instead of ``replaced``.

    ``days`` are those that changed. Fails if the version exists already.
    """
    gone = {f.path for f in replaced}
    kept = {name: size for name, size in base.files.items() if f"{base.path}/{name}" not in gone}
    folder = f"{base.path}/{added}"
    new = files.list_files(spark, folder) if files.exists(spark, folder) else []
    kept |= {f"{added}/{f.path.rpartition(f'/{added}/')[2]}": f.size for f in new}
    named = sorted({as_text(day) for day in days}, key=str)
    made = Snapshot(base.path, base.version + 1, kept, tuple(named), rejects)
    record = json.dumps({"files": made.files, "days": named, "rejects": rejects}, indent=0)
    if not files.write_once(spark, f"{base.path}/{LOG}/{_name(made.version)}", record):
        files.remove(spark, [folder])
        raise VersionTaken(f"version {made.version} of {base.path} was made by another writer")
    return made


def changed_days(spark: SparkSession, path: str, after: int) -> tuple[int, set[str | None]]:
    """The newest version, and the days that changed since version ``after``.

    Where records in between have expired, every stored day counts as changed.
    """
    known = versions(spark, path)
    later = [v for v in known if v > after]
    if not later:
        return after, set()
    if after + 1 not in known:
        last = _load(spark, path, later[-1])
        return last.version, last.stored_days()
    return later[-1], {day for v in later for day in _load(spark, path, v).days}


def expire(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Remove all versions but the newest ``keep``, and the files only they held.

    Call it when no reader of an old version is left. Files of a merge that is
    still running belong to no version yet and stay.
    """
    known = versions(spark, path)
    old, live = known[:-keep], known[-keep:]
    held = set().union(*(_load(spark, path, v).files for v in live))
    dead = set().union(*(_load(spark, path, v).files for v in old)) - held
    # Records go first: what they name may be missing from now on.
    files.remove(spark, [f"{path}/{LOG}/{_name(v)}" for v in old])
    files.remove(spark, [f"{path}/{name}" for name in sorted(dead)])
    return len(dead)
