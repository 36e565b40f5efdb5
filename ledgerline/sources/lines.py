"""The lines relation: ``src``, ``line_no`` (1-based), ``line``.

Text files are read by Spark's text source and split at its usual block size, so one huge file is
spread over many tasks. Line numbers are worked out from per-split counts: a first pass counts the
lines of every split, a running sum over those counts (one row per split, not per line) gives each
split its offset, and a second pass adds the position inside the split. Lines are not shuffled.

What that scan cannot read is read by byte ranges, cut to the same size: files with names it leaves out,
encodings with several bytes per character, and lines that also end at further Unicode breaks. So are more
than ``SCANNED_FILES`` files: a scan takes their names through the driver and packs few into a task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.functions.text import text_lines
from ledgerline.scale import broadcast_if_small, stage
from ledgerline.sources import rangeread
from ledgerline.sources.listing import Listing, listing

LINES = "src string, line_no bigint, line string"
_SCAN = "src string, block bigint, pos bigint, line string"
_TO_END = 2147483647

# What decides how files are cut into splits and packed into tasks.
_SPLIT_SETTINGS = {
    "spark.sql.files.maxPartitionBytes": "134217728",
    "spark.sql.files.openCostInBytes": "4194304",
    "spark.sql.files.minPartitionNum": None,
    "spark.sql.files.maxPartitionNum": None,
}
#: Files that Spark's scan is given by name, and what one more file costs a task that reads ranges.
SCANNED_FILES = 256
_RANGE_COST = 128 << 10
_GLOB_CHARACTERS = "\\{}[]*?"


def source_path(mask: str, path: str) -> str:
    """Folder and wildcard as one glob: back-slashes become slashes, one at the end is dropped.

    ``*``, ``?`` and ``[...]`` are wildcards; braces are plain characters.
    """
    if path.endswith("\\"):
        path = path[:-1]
    folder = path.replace("\\", "/")
    return f"{folder}/{mask}".replace("{", "\\{").replace("}", "\\}")


def _escaped(path: str) -> str:
    return "".join("\\" + c if c in _GLOB_CHARACTERS else c for c in path)


def split_session(spark: SparkSession) -> SparkSession:
    """A session of our own for scans that are read twice.

    Splits follow the settings of the session that made the scan. Here they are fixed: copied from
    the caller's session once and independent of how many executors are alive, so neither later
    changes of the caller's settings nor lost executors move a split, and the caller's session keeps
    its settings.
    """
    own = spark.newSession()
    for name, default in _SPLIT_SETTINGS.items():
        value = spark.conf.get(name, default)
        if value is None and name.endswith("minPartitionNum"):
            value = spark.conf.get("spark.sql.leafNodeDefaultParallelism", None)
            value = value or str(spark.sparkContext.defaultParallelism)
        if value is not None:
            own.conf.set(name, value)
    return own


def of_session(spark: SparkSession, df: DataFrame) -> DataFrame:
    """A frame of another session as one of this session; the scan below keeps its own settings."""
    return spark.createDataFrame([], df.schema).unionByName(df)


def matching_files(
    reader: DataFrameReader, found: Listing, mask: str, path: str, recursive: bool, source: str
) -> DataFrame | None:
    """The listed files that Spark can scan, read by ``source``; None if there are none.

    Without ``recursive`` the files are named one by one, so folders beside them (an output folder,
    say) are neither entered nor taken for partitions.
    """
    if not found.plain:
        return None
    files = reader.format(source)
    if recursive:
        # Names are globs here too: a folder name may hold a glob character.
        every = [_escaped(r["path"]) for r in found.folders.collect()]
        name = source_path(mask, path).rpartition("/")[2]
        return files.option("recursiveFileLookup", True).option("pathGlobFilter", name).load(every)
    plain = found.files.filter("bytes > 0 and not odd").select("path").orderBy("path")
    return files.load([_escaped(r["path"]) for r in plain.collect()])


def _decoded_path(path: Column) -> Column:
    # The metadata column percent-encodes special characters; a plus sign there is a plus sign.
    plain = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.when(path.contains("%"), plain).otherwise(path)


def list_files(
    spark: SparkSession, mask: str, path: str, *, recursive: bool = False, hidden: bool = False
) -> DataFrame:
    """Files that match: ``src``, ``name``, ``bytes``. No match gives no rows. No content is read.

    Files without content are listed with 0 bytes.
    """
    return listing(spark, mask, path, recursive, hidden).files.select(F.col("path").alias("src"), "name", "bytes")


def _decoded(value: Column, encoding: str) -> Column:
    charset = encoding.upper()
    return value if charset in ("UTF-8", "UTF8") else F.decode(value.cast("binary"), charset)


def _is_wide(encoding: str) -> bool:
    """Whether characters have several bytes each, so that line ends are no single bytes."""
    return encoding.upper().replace("_", "-").startswith(("UTF-16", "UTF-32", "UTF16", "UTF32"))


def _is_many(found: Listing, encoding: str) -> bool:
    """Whether the files are too many for a scan, and byte ranges read them alike."""
    return found.plain > SCANNED_FILES and not found.coded and encoding.upper() in ("UTF-8", "UTF8")


def source_name(spark: SparkSession, names: str, folder: str, f: Column, encoded: bool = True) -> Column:
    """How the file ``f`` is called: full ``path``, ``name``, or path ``relative`` to the folder.

    Plain names repeat if files of several folders are read. A folder given as a wildcard has no
    relative paths, so full paths stand in for them.
    """
    full = _decoded_path(f) if encoded else f
    if names == "name":
        return F.substring_index(full, "/", -1)
    if names == "path":
        return full
    if names != "relative":
        raise ValueError(f"unknown source naming: {names}")
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(source_path("", folder))
    store = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    base = store.makeQualified(hadoop).toString() + "/"
    return F.when(full.startswith(base), F.substring(full, len(base) + 1, _TO_END)).otherwise(full)


def _scan(
    spark: SparkSession, found: Listing, mask: str, path: str, recursive: bool, encoding: str
) -> DataFrame | None:
    """One row per line with its split: ``f``, ``split_start``, ``size``, ``pos``, ``line``.

    ``pos`` grows with the line inside one split. It is taken directly on the scan, before any
    filter, so that every pass over the same files sees the same values.
    """
    text = matching_files(split_session(spark).read, found, mask, path, recursive, "text")
    if text is None:
        return None
    meta = F.col("_metadata")
    scanned = text.select(
        meta["file_path"].alias("f"),
        meta["file_block_start"].alias("split_start"),
        meta["file_block_length"].alias("size"),
        F.monotonically_increasing_id().alias("pos"),
        _decoded(F.col("value"), encoding).alias("line"),
    )
    return of_session(spark, scanned)


@dataclass(frozen=True)
class Ranges:
    """Byte ranges of files: ``src``, ``f``, ``bytes``, ``packed``, ``start``, ``end``, and in how many
    tasks they are read."""

    df: DataFrame
    tasks: int


def byte_ranges(spark: SparkSession, files: DataFrame, source: Column) -> Ranges:
    """Files with content cut like splits of a scan. Packed files are one range, as they have no
    places to begin at."""

    def bytes_of(name: str) -> int:
        return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(
            spark.conf.get(name, _SPLIT_SETTINGS[name])
        )

    size = max(4, bytes_of("spark.sql.files.maxPartitionBytes") // 4 * 4)  # whole units of any encoding
    endings = "|".join(e[1:] for e in rangeread.PACKED)
    packed = F.lower("path").rlike(rf"\.({endings})$")
    starts = F.when(packed, F.array(F.lit(0).cast("long"))).otherwise(
        F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(size).cast("long"))
    )
    ranges = files.filter("bytes > 0").select(
        source.alias("src"), F.col("path").alias("f"), "bytes", packed.alias("packed"), F.explode(starts).alias("start")
    )
    end = F.when(F.col("packed"), F.col("bytes")).otherwise(F.least(F.col("start") + size, F.col("bytes")))
    staged = stage(ranges.withColumn("end", end), "line-ranges", gather=True, total=F.sum(end - F.col("start")))
    cost = (staged.metrics["total"] or 0) + staged.rows * min(_RANGE_COST, bytes_of("spark.sql.files.openCostInBytes"))
    tasks = max(-(-cost // size), spark.sparkContext.defaultParallelism)
    return Ranges(staged.df, max(1, min(staged.rows, tasks)))


def _range_lines(ranges: Ranges, encoding: str, wide: bool, numbered: bool = False) -> DataFrame:
    """Lines of the ranges, each task reading its part of them; only the ranges are moved."""
    columns = "src string, block bigint, pos bigint, line string"
    columns += ", line_no bigint, src_lines bigint" * numbered
    rows = partial(rangeread.line_rows, encoding=encoding, wide=wide, numbered=numbered)
    return ranges.df.repartition(ranges.tasks).mapInArrow(rows, columns)


def _number_ranges(ranges: Ranges, encoding: str, wide: bool) -> NumberedLines:
    """Numbered lines of the ranges: one pass counts the lines of every range, a running sum over the
    ranges of a file gives offsets, which the reading tasks add."""
    schema = "src string, f string, bytes bigint, packed boolean, start bigint, end bigint, n bigint"
    rows = partial(rangeread.count_rows, encoding=encoding, wide=wide)
    counted = ranges.df.repartition(ranges.tasks).mapInArrow(rows, schema)
    file = Window.partitionBy("f")
    before = file.orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    placed = stage(
        counted.withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0))).withColumn(
            "src_lines", F.sum("n").over(file)
        ),
        "range-counts",
        gather=True,
    )
    sized = _range_lines(Ranges(placed.df, ranges.tasks), encoding, wide, numbered=True).select(
        "src", "line_no", "line", "src_lines", "block"
    )
    counts = placed.df.groupBy("src", "f").agg(F.sum("n").alias("lines")).select("src", "lines")
    return NumberedLines(sized.drop("src_lines", "block"), counts, sized)


def read_lines(
    spark: SparkSession,
    mask: str,
    path: str,
    *,
    recursive: bool = False,
    encoding: str = "UTF-8",
    names: str = "path",
    hidden: bool = False,
) -> DataFrame:
    """Lines of all matching files without ordinals: ``src``, ``block``, ``pos``, ``line``.

    One pass and no shuffle of lines, for work that looks at each line alone. ``block`` (start byte of
    the split) and then ``pos`` give the order within a source. Spark's text scan reads what it can;
    names it leaves out and wide encodings are read by byte ranges.
    """
    source = source_name(spark, names, path, F.col("f"))
    by_range = source_name(spark, names, path, F.col("path"), encoded=False)
    found = listing(spark, mask, path, recursive, hidden)
    ranged = _is_wide(encoding) or _is_many(found, encoding)
    scanned = None if ranged else _scan(spark, found, mask, path, recursive, encoding)
    parts = []
    if scanned is not None:
        parts.append(scanned.select(source.alias("src"), F.col("split_start").alias("block"), "pos", "line"))
    if found.odd or (ranged and found.plain):
        files = found.files if ranged else found.files.filter("odd")
        parts.append(_range_lines(byte_ranges(spark, files, by_range), encoding, False))
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], _SCAN)


@dataclass(frozen=True)
class NumberedLines:
    """Lines with ordinals, and what the counting pass knows about their sources.

    ``counts`` has the number of ``lines`` per source, 0 for files without content. ``sized`` is ``lines`` with that number on
    each line as ``src_lines``, which takes no join on the source, and with the first byte of the
    split that holds the line as ``block``.
    """

    lines: DataFrame
    counts: DataFrame
    sized: DataFrame


def read_numbered_lines(
    spark: SparkSession,
    mask: str,
    path: str,
    *,
    recursive: bool = False,
    encoding: str = "UTF-8",
    names: str = "path",
    unicode_breaks: bool = False,
    hidden: bool = False,
) -> DataFrame:
    """Lines of all matching files with ordinals: ``src``, ``line_no``, ``line``.

    Runs one counting pass when called. Its result, a few numbers per split, is kept in the shared
    folder; it is broadcast when small, else joined on the split, whose lines are bounded by the
    split size. Both passes cut the files alike, whatever happens to the caller's settings in between,
    and read what the files held when they were listed. ``unicode_breaks`` also breaks lines at vertical tab, form feed,
    U+001C to U+001E, U+0085, U+2028 and U+2029; such files are read by byte ranges.
    """
    return read_counted_lines(
        spark,
        mask,
        path,
        recursive=recursive,
        encoding=encoding,
        names=names,
        unicode_breaks=unicode_breaks,
        hidden=hidden,
    ).lines


def read_counted_lines(
    spark: SparkSession,
    mask: str,
    path: str,
    *,
    recursive: bool = False,
    encoding: str = "UTF-8",
    names: str = "path",
    unicode_breaks: bool = False,
    hidden: bool = False,
) -> NumberedLines:
    """``read_numbered_lines`` together with the line counts, which cost no further pass."""
    source = source_name(spark, names, path, F.col("f"))
    by_range = source_name(spark, names, path, F.col("path"), encoded=False)
    found = listing(spark, mask, path, recursive, hidden)
    empty = found.files.filter("bytes = 0").select(by_range.alias("src"), F.lit(0).cast("long").alias("lines"))
    ranged = unicode_breaks or _is_wide(encoding) or _is_many(found, encoding)
    scanned = None if ranged else _scan(spark, found, mask, path, recursive, encoding)
    parts = [] if scanned is None else [number_scanned(scanned, {"src": source}, ["f"], ["split_start"])]
    if found.odd or (ranged and found.plain):
        files = found.files if ranged else found.files.filter("odd")
        parts.append(_number_ranges(byte_ranges(spark, files, by_range), encoding, unicode_breaks))
    if not parts:
        sized = spark.createDataFrame([], f"{LINES}, src_lines bigint, block bigint")
        return NumberedLines(sized.drop("src_lines", "block"), empty, sized)
    lines, sized = (reduce(DataFrame.unionByName, [getattr(p, n) for p in parts]) for n in ("lines", "sized"))
    return NumberedLines(lines, reduce(DataFrame.unionByName, [*[p.counts for p in parts], empty]), sized)


def number_scanned(
    scanned: DataFrame,
    names: Mapping[str, Column],
    within: Sequence[str],
    order: Sequence[str],
) -> NumberedLines:
    """Number the lines of a scan ``within`` some columns, its splits taken in ``order``.

    ``scanned`` has ``f``, ``split_start``, ``size``, ``pos``, ``line`` and may have more columns
    that are the same for a whole file. ``names`` are the columns that name a source in the result,
    worked out once per split in the counting pass.
    """
    per_split = [c for c in scanned.columns if c not in ("pos", "line")]
    named = [column.alias(name) for name, column in names.items()]
    split_key = F.xxhash64("f", "split_start", "size").alias("split_key")
    source = Window.partitionBy(*within)
    before = source.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    splits = stage(
        scanned.groupBy(*per_split)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("pos").alias("first_pos"),
        )
        .select(
            *named,
            split_key,
            "n",
            "first_pos",
            F.coalesce(F.sum("n").over(before), F.lit(0)).cast("long").alias("offset"),
            F.sum("n").over(source).alias("src_lines"),
        ),
        "line-counts",
    )
    if splits.df.groupBy("split_key").count().filter("count > 1").take(1):
        raise ValueError("two file splits share one key")
    counts = splits.df.groupBy(*names).agg(F.sum("n").alias("lines"))
    placed = splits.narrowed("split_key", "n", "first_pos", "offset", "src_lines")
    keyed = scanned.select(*named, split_key, "split_start", "pos", "line")
    joined = keyed.join(broadcast_if_small(placed), "split_key", "left")
    inside = F.col("pos") - F.col("first_pos")
    sound = (inside >= 0) & (inside < F.col("n"))
    changed = F.raise_error(F.lit("the files were cut differently in two passes")).cast("long")
    extra = ["src_lines", F.col("split_start").alias("block")]
    number = F.when(sound, F.col("offset") + inside + 1).otherwise(changed)
    sized = joined.select(*names, number.alias("line_no"), "line", *extra)
    return NumberedLines(sized.drop("src_lines", "block"), counts, sized)


def explode_lines(
    table: DataFrame, src: str, text: str, *, unicode_breaks: bool = False
) -> DataFrame:
    """Lines of texts held in a column: ``src``, ``line_no``, ``line``.

    Lines end at LF, CR or CRLF; a final line end adds no line and an empty text has none.
    """
    # The split stays inside the generator: as a column of its own it would also become a filter.
    return table.select(
        F.col(src).cast("string").alias("src"),
        F.posexplode(text_lines(F.col(text), unicode_breaks)).alias("at", "line"),
    ).select("src", (F.col("at") + 1).cast("long").alias("line_no"), "line")


def number_rows(
    rows: DataFrame, src: str, order: Sequence[str], bucket: Column, number: str = "line_no"
) -> DataFrame:
    """Add the 1-based ordinal of each row within its ``src``, without a window over a whole source.

    ``bucket`` must not decrease along ``order`` and must cut a source into groups of bounded size.
    Offsets come from one count per (source, bucket).
    """
    marked = rows.withColumn("__bucket", bucket)
    counts = marked.groupBy(src, "__bucket").agg(F.count(F.lit(1)).alias("__n"))
    before = (
        Window.partitionBy(src).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = counts.select(
        src, "__bucket", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset")
    )
    inside = Window.partitionBy(src, "__bucket").orderBy(*order)
    return (
        marked.join(offsets, [src, "__bucket"])
        .withColumn(number, (F.col("__offset") + F.row_number().over(inside)).cast("long"))
        .drop("__bucket", "__offset")
    )
