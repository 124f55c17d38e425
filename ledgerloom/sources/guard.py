"""One run at a time: numbered claims in a folder beside the warehouse, which a run renews."""

from __future__ import annotations

import json
import os
import re
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

# Seconds between renewals, and without one until a run counts as dead.
RENEW_EVERY = 30.0
DEAD_AFTER = 600.0

CLAIM, BEAT, ENDED = "claim", "beat", "ended"
_NAME = re.compile(r"(\d{12})\.(claim|beat|ended)")


class RunRefused(RuntimeError):
    """Another run is at work."""


class RunLost(RuntimeError):
    """Another run has taken this one for dead and gone on in its place."""


@dataclass(frozen=True)
class Claim:
    number: int
    owner: str


class Folder:
    """Small files in a folder that all drivers reach, through Spark's file systems."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        hadoop = spark._jvm.org.apache.hadoop.fs
        self._new_path = hadoop.Path
        self.path = self._new_path(path)
        self._fs = self.path.getFileSystem(spark._jsc.hadoopConfiguration())
        self.path = self._fs.makeQualified(self.path)
        self._fs.mkdirs(self.path)

    def _file(self, name: str):
        return self._new_path(self.path, name)

    def create_once(self, name: str, text: str) -> bool:
        """Create a file unless it is there; of several drivers at once only one does.

        A local file is created by the operating system's exclusive open, any other by the file
        system's create without overwriting, which has to be atomic there: HDFS's is, an object store's
        where it offers conditional writes.
        """
        if self._fs.getScheme() == "file":
            try:
                opened = os.open(f"{self.path.toUri().getPath()}/{name}", os.O_CREAT | os.O_EXCL | os.O_WRONLY)
            except FileExistsError:
                return False
            with os.fdopen(opened, "w") as file:
                file.write(text)
            return True
        try:
            self._write(name, text, False)
        except Py4JJavaError as error:
            if "AlreadyExists" in str(error.java_exception):
                return False
            raise
        return True

    def write(self, name: str, text: str = "") -> None:
        self._write(name, text, True)

    def _write(self, name: str, text: str, overwrite: bool) -> None:
        stream = self._fs.create(self._file(name), overwrite)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def read(self, name: str) -> str:
        stream = self._fs.open(self._file(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def delete(self, name: str) -> None:
        self._fs.delete(self._file(name), False)

    def times(self) -> dict[str, int]:
        """Names and when they were written, by the clock of the file system, in milliseconds."""
        return {one.getPath().getName(): one.getModificationTime() for one in self._fs.listStatus(self.path)}


class RunGuard:
    """Lets one run at a time into a warehouse.

    A run claims the next number by a file that only one can create, and renews it as long as it lives.
    The highest number counts: another run is refused while it is neither ended nor older than
    ``dead_after`` seconds since its last renewal, and takes the number after it otherwise. A run that was
    taken for dead (a driver that stood still) finds a higher number at its next step and stops
    there. A write it had under way at that very moment is not called back, so ``dead_after`` has to be
    longer than a driver may stand still.
    """

    def __init__(
        self, spark: SparkSession, folder: str, renew_every: float = RENEW_EVERY, dead_after: float = DEAD_AFTER
    ) -> None:
        if renew_every * 2 > dead_after:
            raise ValueError("a run must be renewed at least twice before it counts as dead")
        self.folder = Folder(spark, folder)
        self.renew_every = renew_every
        self.dead_after = dead_after

    def claim(self, note: str = "") -> Claim:
        """Claim the next number, or raise :class:`RunRefused`."""
        owner = uuid.uuid4().hex
        self.folder.write(f"now-{owner}")
        times = self.folder.times()
        # Compared with a file written just now, so that clocks of drivers do not matter.
        now = times[f"now-{owner}"]
        self.folder.delete(f"now-{owner}")
        found = self._numbers(times)
        last = max(found, default=0)
        if last and ENDED not in found[last]:
            renewed = max(found[last].values())
            if now - renewed < self.dead_after * 1000:
                raise RunRefused(f"run {last} is at work ({self._note(last)})")
        mine = Claim(last + 1, owner)
        if not self.folder.create_once(_name(mine.number, CLAIM), json.dumps({"owner": owner, "note": note})):
            raise RunRefused(f"run {mine.number} has just begun ({self._note(mine.number)})")
        for number, kinds in found.items():
            if number < last:
                for kind in kinds:
                    self.folder.delete(_name(number, kind))
        return mine

    def renew(self, claim: Claim) -> None:
        self.check(claim)
        self.folder.write(_name(claim.number, BEAT))

    def check(self, claim: Claim) -> None:
        """Raise :class:`RunLost` if another run has taken over."""
        last = max(self._numbers(self.folder.times()), default=0)
        if last != claim.number:
            raise RunLost(f"run {claim.number} was taken for dead; run {last} has gone on in its place")

    def end(self, claim: Claim) -> None:
        self.folder.write(_name(claim.number, ENDED))

    @contextmanager
    def run(self, note: str = "") -> Iterator[Claim]:
        """A claimed run, renewed in the background; it ends with the block, also if that fails."""
        mine, done = self.claim(note), threading.Event()

        def keep() -> None:
            while not done.wait(self.renew_every):
                try:
                    self.renew(mine)
                except RunLost:
                    return

        renewing = threading.Thread(target=keep, daemon=True)
        renewing.start()
        try:
            yield mine
        finally:
            done.set()
            renewing.join()
            self.end(mine)

    def _numbers(self, times: dict[str, int]) -> dict[int, dict[str, int]]:
        found: dict[int, dict[str, int]] = {}
        for name, at in times.items():
            if match := _NAME.fullmatch(name):
                found.setdefault(int(match[1]), {})[match[2]] = at
        return {number: kinds for number, kinds in found.items() if CLAIM in kinds}

    def _note(self, number: int) -> str:
        try:
            return json.loads(self.folder.read(_name(number, CLAIM)))["note"] or "no note"
        except (Py4JJavaError, ValueError):
            # Claimed, but not written yet, or gone since.
            return "no note yet"


def _name(number: int, kind: str) -> str:
    return f"{number:012d}.{kind}"
