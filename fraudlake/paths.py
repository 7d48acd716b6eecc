"""Lake locations (data + checkpoints) and the layer-isolation guard."""

from __future__ import annotations

import hashlib
import os
import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError


def _norm(p: str) -> str:
    return p.rstrip("/") + "/"


def overlaps(a: str, b: str) -> bool:
    """True when one path equals, contains or lies inside the other."""
    na, nb = _norm(a), _norm(b)
    return na.startswith(nb) or nb.startswith(na)


def guard_output(target: str, sources: tuple[str, ...] | list[str] = ()) -> None:
    """Refuse to write where a source lives (equal, above or below it)."""
    for s in sources:
        if s and overlaps(target, s):
            raise ValueError(f"output {target!r} overlaps source {s!r}: raw layers are never outputs")


def name_clash(source_names, output_names) -> set[str]:
    """Names that are both a source and an output (must be empty)."""
    return set(source_names) & set(output_names)


@dataclass(frozen=True)
class LakePaths:
    """Two data paths and two checkpoints for the Bronze streams, plus marts.

    ``root`` may be a local folder or an object-store URI (``s3a://bucket``);
    credentials and endpoints go into the session's ``spark.hadoop.fs.s3a.*``
    settings, never into code.
    """

    root: str

    def _p(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    @property
    def bronze(self) -> str:
        return self._p("bronze", "transactions")

    @property
    def quarantine(self) -> str:
        return self._p("bronze", "transactions_dq_rejected")

    @property
    def bronze_checkpoint(self) -> str:
        return self._p("checkpoints", "bronze_transactions")

    @property
    def quarantine_checkpoint(self) -> str:
        return self._p("checkpoints", "bronze_dq_rejected")

    @property
    def gold(self) -> str:
        return self._p("gold", "gold_transactions")

    @property
    def registry(self) -> str:
        return self._p("gdpr", "gdpr_requests")

    @property
    def audit(self) -> str:
        return self._p("gdpr", "audit")

    @property
    def splits(self) -> tuple[str, str]:
        return self._p("gold", "train"), self._p("gold", "test")

    @property
    def model(self) -> str:
        return self._p("model")

    def check_disjoint(self) -> None:
        data = [self.bronze, self.quarantine, self.gold, self.registry, self.audit, *self.splits, self.model]
        ckpt = [self.bronze_checkpoint, self.quarantine_checkpoint]
        for i, a in enumerate(data + ckpt):
            for b in (data + ckpt)[i + 1 :]:
                if overlaps(a, b):
                    raise ValueError(f"{a!r} and {b!r} overlap")


# --- file-system actions (exists / rename / delete) -----------------------------
# PySpark has no public API for these; they go through the Hadoop FileSystem of
# the session, so they work on any store the session can read (local, HDFS, S3A).

def _fs(spark, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def path_exists(spark, path: str) -> bool:
    fs, jpath = _fs(spark, path)
    return bool(fs.exists(jpath))


def rename_path(spark, src: str, dst: str) -> bool:
    fs, jsrc = _fs(spark, src)
    return bool(fs.rename(jsrc, _fs(spark, dst)[1]))


def delete_path(spark, path: str) -> None:
    fs, jpath = _fs(spark, path)
    fs.delete(jpath, True)


def list_names(spark, path: str) -> list[str]:
    """Names in a folder (none where it does not exist)."""
    fs, jpath = _fs(spark, path)
    try:
        return sorted(s.getPath().getName() for s in fs.listStatus(jpath))
    except Py4JJavaError as e:
        if "FileNotFoundException" in str(e.java_exception.getClass().getName()):
            return []
        raise


def read_text(spark, path: str) -> str:
    """A small file (a log entry) as text."""
    fs, jpath = _fs(spark, path)
    stream = fs.open(jpath)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_if_absent(spark, path: str, text: str) -> bool:
    """Write a small file in one step; False when there is one of that name already.

    The text goes to a hidden file first. On a local file system a hard link gives it
    its name (which fails where the name is taken); elsewhere a rename without overwrite,
    which HDFS does in one step. Stores without such a rename need one writer at a time.
    """
    folder, name = path.rsplit("/", 1)
    hidden = f"{folder}/._{name}_{uuid.uuid4().hex}"
    fs, jhidden = _fs(spark, hidden)
    fs.mkdirs(_fs(spark, folder)[1])
    stream = fs.create(jhidden, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    real = fs.resolvePath(jhidden).toUri()
    try:
        if real.getScheme() == "file":
            local = real.getPath()
            try:
                os.link(local, os.path.join(os.path.dirname(local), name))
            except FileExistsError:
                return False
            return True
        jvm, target = spark._jvm, _fs(spark, path)[1]
        if fs.exists(target):
            return False
        rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
        try:
            context.rename(jhidden, target, spark.sparkContext._gateway.new_array(rename, 0))
        except Py4JJavaError as e:
            if "FileAlreadyExistsException" in str(e.java_exception.getClass().getName()):
                return False
            raise
        return True
    finally:
        fs.delete(jhidden, False)


def fingerprint(spark, path: str) -> str:
    """A hash of the names, sizes and times of a folder's files: it changes when the folder is written to."""
    fs, jpath = _fs(spark, path)
    files, found = fs.listFiles(jpath, True), []
    while files.hasNext():
        f = files.next()
        found.append(f"{f.getPath()} {f.getLen()} {f.getModificationTime()}")
    return hashlib.sha256("\n".join(sorted(found)).encode()).hexdigest()
