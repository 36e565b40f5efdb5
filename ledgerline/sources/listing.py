"""Files that match a mask, listed by tasks.

A mask is a path of levels. The levels from the first wildcard on are listed one after the other: the
folders found so far are dealt to tasks, and what they hold is staged. The driver sees numbers of folders
and files only.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import partial, reduce

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.scale import Staged, stage
from ledgerline.sources import rangeread, zipstream

# The helpers travel with the tasks, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(rangeread)
cloudpickle.register_pickle_by_value(zipstream)

_FOUND = "path string, name string, bytes bigint, folder boolean, odd boolean"
_FOLDERS_PER_TASK = 16
_WILD = re.compile(r"[*?\[]")


def name_pattern(mask: str) -> str:
    """A wildcard for names as a regular expression: ``*``, ``?``, ``[...]``, ``[!...]`` and ``[^...]``."""
    out, at = [], 0
    while at < len(mask):
        c, at = mask[at], at + 1
        if c == "*":
            out.append(".*")
        elif c == "?":
            out.append(".")
        elif c == "[" and (end := mask.find("]", at + 1 + (mask[at : at + 1] in ("!", "^")))) > 0:
            inner = mask[at:end]
            negated = inner[0] in "!^"
            chars = re.sub(r"([\\\[\]^&~|])", r"\\\1", inner[1:] if negated else inner)
            out.append(f"[{'^' if negated else ''}{chars}]")
            at = end + 1
        else:
            out.append(re.escape(c))
    return "".join(out)


def plain_path(mask: str, path: str) -> str:
    """Folder and mask as one path: back-slashes of the folder become slashes, one at its end is dropped."""
    return (path[:-1] if path.endswith("\\") else path).replace("\\", "/") + "/" + mask


def qualified(spark: SparkSession, path: str) -> str:
    """The path with scheme and authority, as Spark writes it."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path or "/")
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(hadoop).toString()


@dataclass(frozen=True)
class Listing:
    """Files that match a mask.

    ``files`` has ``path``, ``name``, ``bytes`` and ``odd`` (a scan of Spark would leave the file out
    because of its name or that of a folder). ``plain`` and ``odd`` count those with content, ``coded`` the
    plain ones in a packing that only Spark reads. ``folders`` has the ``path`` of the folders that the folder part of the mask matches.
    """

    files: DataFrame
    folders: DataFrame
    plain: int
    odd: int
    coded: int = 0


def _listed(folders: DataFrame, n: int, mask: str, files: bool, inner: str, dots: bool, name: str) -> Staged:
    dealt = folders.select("path", "odd")
    if n > 1:
        asked = max(-(-n // _FOLDERS_PER_TASK), folders.sparkSession.sparkContext.defaultParallelism)
        dealt = dealt.repartition(min(n, asked))
    rows = partial(
        rangeread.folder_rows, wanted=name_pattern(mask), files=files, folders=inner, dots=dots or mask.startswith(".")
    )
    full = F.coalesce(F.col("bytes"), F.lit(0)) > 0
    return stage(
        dealt.mapInArrow(rows, _FOUND),
        name,
        gather=True,
        inner=F.count_if("folder"),
        plain=F.count_if(full & ~F.col("odd")),
        odd=F.count_if(full & F.col("odd")),
        coded=F.count_if(full & ~F.col("odd") & F.lower("name").rlike(r"\.(deflate|lz4|snappy)$")),
    )


def listing(
    spark: SparkSession, mask: str, path: str, recursive: bool = False, hidden: bool = False
) -> Listing:
    """What a mask matches. With ``recursive`` all folders below are entered, whatever their names.

    As in a shell, a name with a dot in front is matched by a mask with one only, unless ``hidden``.
    """
    *levels, name = plain_path(mask, path).split("/")
    wild = next((i for i, level in enumerate(levels) if _WILD.search(level)), len(levels))
    root = qualified(spark, "/".join(levels[:wild]))
    folders, n = spark.createDataFrame([(root, False)], "path string, odd boolean").coalesce(1), 1
    for level in levels[wild:]:
        found = _listed(folders, n, level, False, "wanted", hidden, "folders")
        folders, n = found.df, found.rows
    top = folders.select("path")
    parts = [_listed(folders, n, name, True, "all" if recursive else "none", hidden, "files")]
    while parts[-1].metrics["inner"]:
        below = parts[-1].df.filter("folder")
        parts.append(_listed(below, parts[-1].metrics["inner"], name, True, "all", hidden, "files"))
    files = reduce(DataFrame.unionByName, [p.df for p in parts]).filter("not folder").drop("folder")
    plain, odd, coded = (sum(p.metrics[k] or 0 for p in parts) for k in ("plain", "odd", "coded"))
    return Listing(files, top, plain, odd, coded)
