"""Archives and checksums: local files only."""

from __future__ import annotations

import shutil
import tarfile
import zipfile
from fnmatch import fnmatch
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class ChecksumError(ValueError):
    """A file isn't the one that was expected."""


def checksums(spark: SparkSession, path: str) -> DataFrame:
    """path and SHA-256 of each file."""
    return spark.read.format("binaryFile").load(path).select("path", F.sha2("content", 256).alias("sha256"))


def verify(spark: SparkSession, path: str, expected: str) -> None:
    wrong = checksums(spark, path).where(F.col("sha256") != expected.lower()).limit(1).collect()
    if wrong:
        raise ChecksumError(f"{wrong[0].path}: {wrong[0].sha256} isn't {expected}")


def _inside(folder: Path, name: str) -> Path:
    """Where a member goes; one that would leave the folder is refused."""
    target = (folder / name).resolve()
    if not target.is_relative_to(folder.resolve()):
        raise ValueError(f"{name!r} leads out of the folder")
    return target


def _wanted(name: str, patterns: list[str] | None) -> bool:
    return not patterns or any(fnmatch(name, p) for p in patterns)


def extract(archive: str | Path, folder: str | Path, patterns: list[str] | None = None) -> list[Path]:
    """Unpack .zip, .tar, .tar.gz or .tgz, of which only members that match a pattern; links and devices are left out."""
    archive, folder, out = Path(archive), Path(folder), []
    folder.mkdir(parents=True, exist_ok=True)
    if archive.suffix == ".zip":
        with zipfile.ZipFile(archive) as z:
            for info in z.infolist():
                if not info.is_dir() and _wanted(info.filename, patterns):
                    target = _inside(folder, info.filename)
                    target.parent.mkdir(parents=True, exist_ok=True)
                    with z.open(info) as member, target.open("wb") as file:
                        shutil.copyfileobj(member, file)
                    out.append(target)
    elif archive.name.endswith((".tar", ".tar.gz", ".tgz")):
        with tarfile.open(archive) as t:
            for member in t.getmembers():
                if member.isfile() and _wanted(member.name, patterns):
                    target = _inside(folder, member.name)
                    target.parent.mkdir(parents=True, exist_ok=True)
                    with t.extractfile(member) as packed, target.open("wb") as file:
                        shutil.copyfileobj(packed, file)
                    out.append(target)
    else:
        raise ValueError(f"unknown kind of archive: {archive.name}")
    return sorted(out)
