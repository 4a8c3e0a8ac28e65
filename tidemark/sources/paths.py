"""Folder conventions: dated zones, run folders and file-name templates.

Listing goes through the Hadoop file system, so any store Spark can read works.
"""

from datetime import datetime
from zoneinfo import ZoneInfo

from pyspark.sql import functions as F


def _fs(spark, path):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark, path) -> bool:
    fs, target = _fs(spark, path)
    return fs.exists(target)


def list_names(spark, path, folders_only=False) -> list[str]:
    """Names directly under ``path``, hidden entries left out."""
    fs, target = _fs(spark, path)
    found = [(s.getPath().getName(), s.isDirectory()) for s in fs.listStatus(target)]
    return sorted(n for n, is_dir in found if n[0] not in "._" and (is_dir or not folders_only))


def latest_partition(spark, path, levels=3):
    """Newest ``YYYY/MM/DD`` folder, taking the greatest name per level; None when there is none."""
    for _ in range(levels):
        names = list_names(spark, path, folders_only=True) if exists(spark, path) else []
        if not names:
            return None
        path = f"{path.rstrip('/')}/{names[-1]}"
    return path


def run_path(path, zone, now, source_zone="BRONZE", tz="Asia/Kolkata") -> str:
    """The same path in another zone, its run folder renamed to the wall time of ``now`` in ``tz``.

    ``now`` is an aware datetime; the run folder is the one that holds the file.
    """
    if now.tzinfo is None:
        now = now.replace(tzinfo=ZoneInfo("UTC"))
    local = now.astimezone(ZoneInfo(tz))
    parts = path.split("/")
    parts[parts.index(source_zone)] = zone
    parts[-2] = local.strftime("%Y-%m-%dT%H-%M-%S.") + f"{local.microsecond // 1000:03d}"
    return "/".join(parts)


def expand_template(folder, file_name, now: datetime):
    """Fill ``YYYY``, ``\\MM\\`` and ``\\DD\\`` in a folder and ``*`` in a file name."""
    folder = folder.replace("YYYY", f"{now:%Y}").replace("\\MM\\", f"\\{now:%m}\\").replace("\\DD\\", f"\\{now:%d}\\")
    return folder, file_name.replace("*", f"{now:%Y%m%d_%H%M%S}")


def expand_template_cols(folder, file_name, ts):
    """``expand_template`` over columns: returns the two filled columns."""
    def part(fmt):
        return F.date_format(ts, fmt)

    filled = F.replace(folder, F.lit("YYYY"), part("yyyy"))
    for mark, fmt in (("\\MM\\", "MM"), ("\\DD\\", "dd")):
        filled = F.replace(filled, F.lit(mark), F.concat(F.lit("\\"), part(fmt), F.lit("\\")))
    return filled, F.replace(file_name, F.lit("*"), part("yyyyMMdd_HHmmss"))
