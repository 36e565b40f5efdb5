"""Customer blocks in feeds shared by many customers.

A block lies between the first header line (``CH``) of a customer in a source and the first trailer
line (``CT``) of the customer after it. Blocks of any number of customers are found in one pass over
the lines, which keeps only header and trailer lines, and cut out in a second pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.text import collapse_whitespace, contains_code
from ledgerline.operators.ranges import BUCKET_LINES, bucketed_ranges, join_ranges
from ledgerline.scale import Staged, is_small, part_of, skew_join, stage

# Line tags, the pattern of the detail rows to keep, the provider name, the 0-based
# slices (end excluded) of a detail row, and the output columns.
HEADER = "CH"
TRAILER = "CT"
DETAIL = "D10[2-9]0101"
PROVIDER = "vendor"
ACCOUNT_NUMBER = (8, 17)
ACCOUNT_HOLDER_1 = (23, 90)
ACCOUNT_HOLDER_2 = (113, 181)
ACCOUNT_HOLDER_OTHER = (204, 272)
HOLDER_COLUMNS = (
    "account_provider_name",
    "account_number",
    "account_holder_1",
    "account_holder_2",
    "account_holder_other",
)

# Where match="field" looks for the code in a header or trailer line: 0-based start and length.
Field = tuple[int, int] | None

# A list of codes, a table with a column code, or None for all.
Codes = Sequence[str] | DataFrame | None


def _codes(line: Column, kind: str, codes, match: str, field: Field) -> Column:
    """Array of the wanted codes that this line is a header (or trailer) of."""
    if match == "field":
        held = F.trim(F.substring(line, field[0] + 1, field[1]))
        wanted = line.startswith(kind) & (held != "")
        if codes is not None:
            wanted = wanted & held.isin(list(codes))
        return F.when(wanted, F.array(held)).otherwise(F.array().cast("array<string>"))
    if codes is None:
        raise ValueError("give the codes, or match='field' to take all of them")
    tests = [F.when(contains_code(line, kind, c, match), F.lit(c)) for c in codes]
    return F.array_compact(F.array(*tests))


# Length of the pieces of codes by which lines are looked up, and patterns tried on a line at a time.
GRAM = 3
PATTERNS_PER_BLOCK = 64

# What a pattern without certain plain text has, and the parts of others that are not certain.
_NO_PLAIN_TEXT = r"[|()\[\]{}^$]|\\[A-Za-z0-9]"
_REPEATED = r"(\\[^A-Za-z0-9]|[^\\])[*+?]+"
_CUT = "\x01"
_ESCAPED = r"\\[^A-Za-z0-9]"


def _plain_runs(code: Column, match: str) -> Column:
    """Pieces of plain text that every line with the code holds; none if that cannot be told."""
    if match == "literal":
        return F.filter(F.array(code), lambda r: r != "")
    runs = F.regexp_replace(F.regexp_replace(code, _REPEATED, _CUT), _ESCAPED, _CUT)
    runs = F.filter(F.split(F.translate(runs, ".", _CUT), _CUT, -1), lambda r: r != "")
    return F.when(code.rlike(_NO_PLAIN_TEXT), F.array().cast("array<string>")).otherwise(runs)


def _grams(text: Column, size: Column) -> Column:
    """All pieces of ``size`` characters of a text."""
    last = F.length(text) - size + 1
    pieces = F.transform(F.sequence(F.lit(1), last), lambda i: F.substring(text, i, size))
    return F.when(last >= 1, pieces).otherwise(F.array().cast("array<string>"))


def _lines_of_codes(lines: DataFrame, codes: Staged, match: str) -> DataFrame:
    """Header and trailer lines of a table of codes that are patterns or plain text.

    A code is known by its rarest piece of ``GRAM`` characters (fewer, if it has none so long) among the
    pieces of all header and trailer lines, and meets only lines with that piece, by an equi-join; hits
    are verified. A code with a piece that no line holds meets none. Patterns without certain plain text
    are tried in blocks on every header and trailer line.
    """
    line, code = F.col("line"), F.col("code")
    tag = F.substring("line", 1, len(HEADER)).alias("kind")
    tagged = lines.filter(line.startswith(HEADER) | line.startswith(TRAILER)).select("src", "line_no", tag, "line")
    tagged = stage(tagged, "tagged-lines", gather=True).df
    body = F.substring(line, len(HEADER) + 1, F.length(line))
    found = F.contains(body, code) if match == "literal" else _has_code(code)

    named = codes.df.select("code", _plain_runs(code, match).alias("runs"))
    longest = F.array_max(F.transform("runs", lambda r: F.length(r)))
    sized = named.withColumn("size", F.least(F.coalesce(longest, F.lit(0)), F.lit(GRAM)))
    pieces = F.array_distinct(F.flatten(F.transform("runs", lambda r: _grams(r, F.col("size")))))
    keys = stage(
        sized.filter("size > 0").select("code", "size", F.explode(pieces).alias("gram")),
        "code-grams",
        sizes=F.expr("bit_or(shiftleft(1, size))"),
    )
    out = tagged.select("src", "line_no", "kind", F.lit(None).cast("string").alias("code")).limit(0)
    if keys.rows:
        sizes = F.array(*[F.lit(n) for n in range(1, GRAM + 1) if keys.metrics["sizes"] >> n & 1])
        every = F.array_distinct(F.flatten(F.transform(sizes, lambda n: _grams(body, n))))
        held = tagged.withColumn("gram", F.explode(every))
        counts = stage(held.groupBy("gram").agg(F.count(F.lit(1)).alias("n")), "line-grams")
        known = skew_join(keys.df, counts, ["gram"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
        rarest = known.groupBy("code").agg(F.min(F.struct("n", "gram")).alias("best")).filter("best.n > 0")
        rarest = stage(rarest.select("code", F.col("best.gram").alias("gram")), "code-keys")
        hits = skew_join(held, rarest, ["gram"], "inner").filter(found)
        out = out.unionByName(hits.select("src", "line_no", "kind", "code"))
    others = stage(sized.filter("size = 0").select("code"), "codes-without-grams")
    if others.rows:
        n = -(-others.rows // PATTERNS_PER_BLOCK)
        blocks = others.df.groupBy(F.pmod(F.xxhash64("code"), F.lit(n)).alias("block")).agg(F.collect_list("code").alias("codes"))
        spread = tagged.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))))
        blocks = F.broadcast(blocks) if is_small(others) else blocks
        test = (lambda c: F.contains(body, c)) if match == "literal" else _has_code
        tried = spread.join(blocks, "block").withColumn("code", F.explode(F.filter("codes", test)))
        out = out.unionByName(tried.select("src", "line_no", "kind", "code"))
    return out


def _has_code(code: Column) -> Column:
    # As in ``contains_code``, with the code as a column.
    return F.rlike(F.col("line"), F.concat(F.lit("(?d)^"), F.col("kind"), F.lit(".*"), code))


def boundary_lines(
    lines: DataFrame,
    codes: Codes,
    match: str = "regex",
    field: Field = None,
) -> DataFrame:
    """Header and trailer lines of the wanted customers: ``src``, ``line_no``, ``kind``, ``code``.

    ``match``: ``regex`` takes a code as a pattern anywhere after the tag, so AB also hits ABC;
    ``literal`` as plain text; ``field`` compares the whole code field, (0-based start, length), which
    the caller gives. With it the codes may also be None for all customers; a code that is longer than
    the field is an error, as it never matches. Codes may be a table with a column ``code``, of any size,
    repeated and null ones counting once and not at all.
    """
    if match == "field" and field is None:
        raise ValueError("match='field' needs the place of the code field")
    if isinstance(codes, DataFrame):
        if match not in ("field", "regex", "literal"):
            raise ValueError(f"unknown match mode: {match}")
        distinct = codes.select(F.col("code").cast("string").alias("code")).filter("code is not null").distinct()
        wanted = stage(distinct, "codes", longest=F.max(F.length("code")))
        if match != "field":
            return _lines_of_codes(lines, wanted, match)
        if (wanted.metrics["longest"] or 0) > field[1]:
            raise ValueError(f"a code is longer than the field of {field[1]} characters")
        everyone = boundary_lines(lines, None, match, field)
        held = skew_join(everyone, wanted, ["code"], "left_semi")
        return held.select("src", "line_no", "kind", "code")
    if codes is not None:
        codes = list(dict.fromkeys(codes))
        if match == "field" and (long := [c for c in codes if len(c) > field[1]]):
            raise ValueError(f"codes longer than the field of {field[1]} characters: {long}")
    line = F.col("line")
    kind = F.when(line.startswith(HEADER), F.lit(HEADER)).otherwise(F.lit(TRAILER))
    hits = F.when(
        line.startswith(HEADER), _codes(line, HEADER, codes, match, field)
    ).otherwise(_codes(line, TRAILER, codes, match, field))
    return lines.filter(line.startswith(HEADER) | line.startswith(TRAILER)).select(
        "src", "line_no", kind.alias("kind"), F.explode(hits).alias("code")
    )


def block_bounds(
    lines: DataFrame,
    codes: Codes,
    match: str = "regex",
    field: Field = None,
) -> DataFrame:
    """Per source and customer with a header: ``start_line`` and ``end_line``.

    ``end_line`` is null if no trailer follows. Stages the boundary lines (one pass over the lines),
    as they are needed more than once.
    """
    marks = stage(boundary_lines(lines, codes, match, field), "boundary-lines", gather=True)
    headers = marks.df.filter(F.col("kind") == HEADER)
    starts = part_of(
        marks,
        headers.groupBy("src", "code").agg(F.min("line_no").alias("start_line")),
        "block-starts",
    )
    trailers = marks.df.filter(F.col("kind") == TRAILER).select("src", "code", "line_no")
    ends = (
        skew_join(trailers, starts, ["src", "code"], "inner")
        .filter(F.col("line_no") > F.col("start_line"))
        .groupBy("src", "code")
        .agg(F.min("line_no").alias("end_line"))
    )
    return starts.df.join(ends, ["src", "code"], "left").select(
        "src", "code", "start_line", "end_line"
    )


def stage_blocks(bounds: DataFrame, width: int = BUCKET_LINES) -> Staged:
    """Closed blocks as staged line ranges, ready to be joined to lines."""
    inner = bounds.filter(F.col("end_line").isNotNull()).select(
        "src",
        "code",
        (F.col("start_line") + 1).alias("__first"),
        (F.col("end_line") - 1).alias("__last"),
    )
    return bucketed_ranges(inner, "__first", "__last", "customer-blocks", width)


def block_lines(lines: DataFrame, blocks: Staged, width: int = BUCKET_LINES) -> DataFrame:
    """Lines strictly inside the blocks: ``src``, ``code``, ``line_no``, ``line``."""
    held = join_ranges(lines, blocks, "__first", "__last", "inner", width)
    return held.select("src", "code", "line_no", "line")


def is_detail(line: Column) -> Column:
    """Whether a line holds the mark of a detail row numbered 2 to 9, at any position."""
    return line.rlike(DETAIL)


def filter_detail_records(lines: DataFrame) -> DataFrame:
    """Only the detail rows 2 to 9."""
    return lines.filter(is_detail(F.col("line")))


def parse_holder_records(lines: DataFrame, provider: str = PROVIDER) -> DataFrame:
    """Replace ``line`` by the account number and holder names cut from it.

    A short line gives empty texts. Names have their whitespace collapsed, the number is kept raw.
    """

    def cut(bounds: tuple[int, int]) -> Column:
        return F.substring("line", bounds[0] + 1, bounds[1] - bounds[0])

    kept = [c for c in lines.columns if c != "line"]
    return lines.select(
        *kept,
        F.lit(provider).alias("account_provider_name"),
        cut(ACCOUNT_NUMBER).alias("account_number"),
        collapse_whitespace(cut(ACCOUNT_HOLDER_1)).alias("account_holder_1"),
        collapse_whitespace(cut(ACCOUNT_HOLDER_2)).alias("account_holder_2"),
        collapse_whitespace(cut(ACCOUNT_HOLDER_OTHER)).alias("account_holder_other"),
    )


def export_lines(
    records: DataFrame, bounds: DataFrame, delimiter: str = "|", quote: str | None = None
) -> DataFrame:
    """Holder records as text: ``src``, ``code``, ``line_no``, ``line``.

    Each closed block gets one line with the column names at ordinal 0, also if it has no records.
    Values are written as they are, unless a ``quote`` is given: then those that hold it or the
    delimiter are put in quotes, a quote inside being doubled.
    """

    def value(name: str) -> Column:
        if not quote:
            return F.col(name)
        inner = F.replace(F.col(name), F.lit(quote), F.lit(quote * 2))
        odd = F.contains(F.col(name), F.lit(delimiter)) | F.contains(F.col(name), F.lit(quote))
        return F.when(odd, F.concat(F.lit(quote), inner, F.lit(quote))).otherwise(F.col(name))

    titles = bounds.filter(F.col("end_line").isNotNull()).select(
        "src",
        "code",
        F.lit(0).cast("long").alias("line_no"),
        F.lit(delimiter.join(HOLDER_COLUMNS)).alias("line"),
    )
    rows = records.select(
        "src", "code", "line_no", F.concat_ws(delimiter, *map(value, HOLDER_COLUMNS)).alias("line")
    )
    return titles.unionByName(rows)


def block_status(
    sources: DataFrame, bounds: DataFrame, records: DataFrame, codes: Codes
) -> DataFrame:
    """Outcome per source and code: ``status`` and the number of ``records``.

    ``sources`` names the sources. A status is ``ok``, ``no_detail``, ``trailer_missing`` or, for
    codes given as a list, ``header_missing``; otherwise only customers with a header are reported.
    """
    if codes is None or isinstance(codes, DataFrame):
        wanted = bounds.select("src", "code")
    else:
        wanted = sources.select("src").distinct().withColumn(
            "code", F.explode(F.array(*[F.lit(c) for c in dict.fromkeys(codes)]))
        )
    counted = records.groupBy("src", "code").agg(F.count(F.lit(1)).alias("records"))
    status = (
        F.when(F.col("start_line").isNull(), "header_missing")
        .when(F.col("end_line").isNull(), "trailer_missing")
        .when(F.col("records").isNull(), "no_detail")
        .otherwise("ok")
    )
    return (
        wanted.join(bounds, ["src", "code"], "left")
        .join(counted, ["src", "code"], "left")
        .select(
            "src",
            "code",
            status.alias("status"),
            F.coalesce("records", F.lit(0).cast("long")).alias("records"),
        )
    )
