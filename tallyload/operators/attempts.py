"""Attempts: who may load which tasks, and whose rows count.

Every run of a batch opens an attempt.  Four kinds of small files below
``<root>/control`` keep attempts apart; each is created only if it is absent,
so of several runs that want the same one, exactly one gets it:

* ``open/b<batch>.a<attempt>``: the lease of a running attempt, kept fresh by
  the run and removed at its end.  Creating it gives the attempt its number.
* ``claims/<n>``: the n-th claim of any attempt.  A run reads what its rivals
  claimed, writes its own claim rows to the ledger and then creates the next
  file.  If another run was faster, it reads again, drops the tasks that are
  taken now, and tries the next number.
* ``commits/b<batch>.a<attempt>``: with content, the attempt is committed; empty,
  it was withdrawn.  Rows of targets and final ledger rows count only once
  their attempt is committed, so a reader sees all rows of an attempt or none.

A run whose lease went stale may be taken over: its attempt is withdrawn first,
so a run that only stalled cannot commit any more.

The files need a file system on which creating or renaming a file fails if the
target exists (HDFS does; object stores without such a rename do not).
"""

from __future__ import annotations

import os
import re
import threading
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyload.operators.sizing import bounded_broadcast

LEASE_SECONDS = 300
_NAME = r"b(-?\d+)\.a(\d+)"


def claim_step(attempt: int) -> int:
    """Step of the claims of an attempt (0, 1, ...); step 0 is for rows that other systems add."""
    return 2 * attempt + 1


def final_step(attempt: int) -> int:
    return 2 * attempt + 2


class Files:
    """Small files below one folder, on any file system that Hadoop knows."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm = spark.sparkContext._jvm
        self.root = root.rstrip("/") or "/"
        self.fs = self._path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self.local = self.fs.getUri().getScheme() == "file"

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def _plain(self, name: str) -> str:
        return self._path(name).toUri().getPath()

    def exists(self, name: str = "") -> bool:
        return self.fs.exists(self._path(name))

    def names(self, folder: str) -> dict[str, tuple[int, float]]:
        """Name to (length, seconds since its last change) of what is in a folder; none if there is no such folder."""
        path = self._path(folder)
        if not self.fs.exists(path):
            return {}
        now = time.time()
        found = {f.getPath().getName(): (f.getLen(), now - f.getModificationTime() / 1000) for f in self.fs.listStatus(path)}
        return {k: v for k, v in found.items() if not k.startswith((".", "_"))}

    def lengths(self) -> list[tuple[str, int]]:
        """Path and length of the files in the folder itself."""
        return [(f.getPath().toString(), f.getLen()) for f in self.fs.listStatus(self._path("")) if f.isFile()]

    def create(self, name: str, text: str = "") -> bool:
        """Create a file with its whole content; False if it exists already."""
        folder = name.rsplit("/", 1)[0]
        self.fs.mkdirs(self._path(folder))
        part = f"{folder}/_{uuid.uuid4().hex}"
        if self.local:
            with open(self._plain(part), "w", encoding="utf-8") as f:
                f.write(text)
            try:
                os.link(self._plain(part), self._plain(name))
                return True
            except FileExistsError:
                return False
            finally:
                os.unlink(self._plain(part))
        out = self.fs.create(self._path(part), True)
        out.write(bytearray(text.encode()))
        out.close()
        if not self.fs.exists(self._path(name)) and self.fs.rename(self._path(part), self._path(name)):
            return True
        self.fs.delete(self._path(part), False)
        return False

    def read(self, name: str) -> str:
        if self.local:
            with open(self._plain(name), encoding="utf-8") as f:
                return f.read()
        source = self.fs.open(self._path(name))
        try:
            return str(self.jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8"))
        finally:
            source.close()

    def touch(self, name: str) -> None:
        self.fs.setTimes(self._path(name), int(time.time() * 1000), -1)

    def delete(self, name: str) -> None:
        self.fs.delete(self._path(name), True)


def _key(batch_id: int, attempt: int) -> str:
    return f"b{batch_id}.a{attempt}"


def _parse(name: str) -> tuple[int, int] | None:
    m = re.fullmatch(_NAME, name)
    return (int(m[1]), int(m[2])) if m else None


def control_root(root: str) -> str:
    return root.rstrip("/") + "/control"


def committed_names(spark: SparkSession, root: str) -> set[tuple[int, int]] | None:
    """Committed (batch id, attempt) below a deployment's root; None where no attempt was ever opened."""
    files = Files(spark, control_root(root))
    if not files.exists():
        return None
    return {_parse(k) for k, (size, _) in files.names("commits").items() if size and _parse(k)}


def committed_attempts(spark: SparkSession, root: str) -> DataFrame | None:
    """``batch_id, attempt`` of all committed attempts, from a listing alone; None where no attempt was ever opened."""
    files = Files(spark, control_root(root))
    if not files.exists():
        return None
    if not files.exists("commits"):
        return spark.createDataFrame([], "batch_id bigint, attempt int")
    listed = spark.read.format("binaryFile").load(f"{files.root}/commits").select("path", "length")
    name = F.element_at(F.split("path", "/"), -1)
    return listed.where((F.col("length") > 0) & name.rlike(f"^{_NAME}$")).select(
        F.regexp_extract(name, _NAME, 1).cast("bigint").alias("batch_id"), F.regexp_extract(name, _NAME, 2).cast("int").alias("attempt"))


def settled(spark: SparkSession, ledger: DataFrame, root: str) -> DataFrame:
    """Ledger rows without final rows of attempts that did not commit (crashed, or still writing them)."""
    commits = committed_attempts(spark, root)
    if commits is None:
        return ledger
    ended = bounded_broadcast(commits.select(F.col("batch_id").alias("_b"), (F.col("attempt") * 2 + 2).alias("_s")))
    final = (F.col("step") > 0) & (F.col("step") % 2 == 0)
    kept = ledger.join(ended, (F.col("batch_id") == F.col("_b")) & (F.col("step") == F.col("_s")), "left")
    return kept.where(~final | F.col("_b").isNotNull()).drop("_b", "_s")


class Attempt:
    """One run of a batch id, from ``open_attempt`` to ``close``."""

    def __init__(self, spark: SparkSession, root: str, batch_id: int, owner: str | None = None, lease: float = LEASE_SECONDS):
        self.spark, self.root, self.batch_id, self.lease = spark, root.rstrip("/"), batch_id, lease
        self.owner = owner or uuid.uuid4().hex
        self.files = Files(spark, control_root(root))
        self.committed, self.number = False, -1
        # a claim of an attempt that still runs comes after that attempt's own beginning
        self.base = min([self._last_claim(), *[base for _, base, _ in self._open().values()]])
        taken = [a for b, a in map(_parse, [*self.files.names("open"), *self.files.names("commits")]) if b == batch_id]
        self.number = max([*taken, *self._steps()], default=-1) + 1
        while not self.files.create(f"open/{self.name}", f"{self.owner}\n{self.base}"):
            self.number += 1  # a rival was faster
        self._stop = threading.Event()
        threading.Thread(target=self._keep_fresh, daemon=True).start()

    @property
    def name(self) -> str:
        return _key(self.batch_id, self.number)

    def _keep_fresh(self) -> None:
        while not self._stop.wait(self.lease / 5):
            try:
                self.files.touch(f"open/{self.name}")
            except Exception:  # the lease goes stale, and then the commit decides
                return

    def _last_claim(self) -> int:
        return max((int(k) for k in self.files.names("claims")), default=0)

    def _steps(self) -> dict[int, set[str]]:
        """Attempts of this batch that wrote to the ledger, with the kinds of rows that they have."""
        found: dict[int, set[str]] = {}
        ledger = Files(self.spark, f"{self.root}/ledger")
        for name in ledger.names(f"batch_id={self.batch_id}"):
            s = int(name.split("=")[1]) if re.fullmatch(r"step=\d+", name) else 0
            if s > 0:
                found.setdefault((s - 1) // 2, set()).add("claim" if s % 2 else "final")
        return found

    def _open(self) -> dict[tuple[int, int], tuple[str, int, bool]]:
        """Other open attempts: owner, claims when they began, and whether their lease is fresh."""
        out = {}
        for name, (_, age) in self.files.names("open").items():
            if name == self.name or not _parse(name):
                continue
            try:
                owner, base = self.files.read(f"open/{name}").split("\n")
            except Exception:  # closed just now
                continue
            out[_parse(name)] = (owner, int(base), age <= self.lease and owner != self.owner)
        return out

    def crashed(self) -> list[int]:
        """Earlier attempts of this batch that ended without a commit; they are withdrawn now and can never commit."""
        others, commits, out = self._open(), self.files.names("commits"), []
        for number, kinds in sorted(self._steps().items()):
            name, key = _key(self.batch_id, number), (self.batch_id, number)
            if number == self.number or (key in others and others[key][2]):
                continue  # own, or running
            if commits.get(name, (0, 0))[0] and "final" in kinds:
                continue
            if not self.files.create(f"commits/{name}") and self.files.names("commits")[name][0]:
                if "final" in self._steps().get(number, ()):
                    continue  # it committed meanwhile
                self.files.delete(f"commits/{name}")  # a commit without its ledger rows
                self.files.create(f"commits/{name}")
            self.files.delete(f"open/{name}")
            out.append(number)
        return out

    def rivals(self) -> tuple[int, list[tuple[int, int]]]:
        """The last claim's number, and other attempts whose claims hold: running ones, and those that committed since this one began."""
        others = self._open()
        running = {k for k, (_, _, fresh) in others.items() if fresh}
        low = min([self.base, *[others[k][1] for k in running]])
        # listed before the claims are read: a rival that commits later is still running here
        last, commits = self._last_claim(), self.files.names("commits")
        found = set()
        for n in range(low + 1, last + 1):
            if self.files.exists(f"claims/{n}"):
                key = _parse(self.files.read(f"claims/{n}").strip())
                if key != (self.batch_id, self.number) and (key in running or commits.get(_key(*key), (0, 0))[0]):
                    found.add(key)
        return last, sorted(found)

    def claim(self, n: int) -> bool:
        """Make the claim rows of this attempt hold, if no other attempt claimed since ``rivals`` returned ``n - 1``."""
        if not self.files.create(f"claims/{n}", self.name):
            return False
        # numbers that no running attempt can still have to read; the last one stays, to count from
        low = min([self.base, *[base for _, base, _ in self._open().values()]])
        for old in self.files.names("claims"):
            if int(old) <= low:
                self.files.delete(f"claims/{old}")
        return True

    def commit(self) -> None:
        """Make all rows of this attempt count, at once."""
        if not self.files.create(f"commits/{self.name}", f"{self.owner}\n"):
            raise RuntimeError(f"attempt {self.name} was taken over and its rows do not count")
        self.committed = True

    def close(self) -> None:
        """End the attempt; without a commit it is withdrawn, and the next run may redo its tasks at once."""
        self._stop.set()
        if not self.committed:
            self.files.create(f"commits/{self.name}")
        self.files.delete(f"open/{self.name}")

    def __enter__(self) -> Attempt:
        return self

    def __exit__(self, *error) -> None:
        self.close()
