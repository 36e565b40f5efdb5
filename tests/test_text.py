"""Hand-made cases of masking, whitespace and paths."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ledgerline.functions import text as tx
from ledgerline.functions.dates import business_date_list, business_dates
from ledgerline.operators import masking


def one(spark, value, expression):
    frame = spark.createDataFrame([(value,)], "line string")
    return frame.select(expression(F.col("line")).alias("out")).first()["out"]


def lines(spark, *values, src="f"):
    rows = [(src, i, v) for i, v in enumerate(values, 1)]
    return spark.createDataFrame(rows, "src string, line_no bigint, line string")


def texts(frame):
    return [r["line"] for r in frame.orderBy("src", "line_no").collect()]


def test_fixed_range_end_is_included_and_line_is_written_once(spark):
    got = texts(masking.mask_fixed(lines(spark, "ABCDEFG1abc-456é89z")))
    assert got == ["ABCDEFG9XXX-999é99z"]


@pytest.mark.parametrize("line", ["", "ABC", "ABCDEFG"])
def test_short_line_is_unchanged(spark, line):
    assert texts(masking.mask_fixed(lines(spark, line))) == [line]


def test_range_past_the_end_masks_what_is_there(spark):
    assert texts(masking.mask_fixed(lines(spark, "ABCDEFG1a"))) == ["ABCDEFG9X"]


def test_nested_and_overlapping_ranges_mask_their_union(spark):
    got = texts(masking.mask_fixed(lines(spark, "a" * 16), [(2, 9), (4, 6), (12, 13)]))
    assert got == ["aaXXXXXXXXaaXXaa"]


@pytest.mark.parametrize("ranges", [[(5, 4)], [(-1, 3)], []])
def test_bad_ranges_are_refused(ranges):
    with pytest.raises(ValueError):
        tx.merge_ranges(ranges)


def test_only_ascii_letters_their_two_relatives_and_digits_are_masked(spark):
    assert one(spark, "aZ09 ıſéß€😀_", tx.mask_text) == "XX99 XXéß€😀_"


def test_masking_is_idempotent_and_keeps_length(spark):
    value = "x1é😀 Ab9-" * 5
    once = one(spark, value, tx.mask_text)
    assert len(once) == len(value)
    assert one(spark, once, tx.mask_text) == once


def test_character_positions_count_code_points(spark):
    assert one(spark, "😀😀ab😀c", lambda c: tx.mask_ranges(c, [(2, 3)])) == "😀😀XX😀c"


def test_delimited_fields_and_no_delimiter_at_the_end(spark):
    got = texts(masking.mask_delimited(lines(spark, "D1|a|b|c|d|Ab1-é|éı|x y|99"), "|"))
    assert got == ["D1|a|b|c|d|XX9-é|éX|X X|99"]


def test_other_rows_and_missing_fields_are_unchanged(spark):
    given = ["H1|a|b|c|d|Ab1", "D1|a", "", "xD1|a|b|c|d|e"]
    assert texts(masking.mask_delimited(lines(spark, *given), "|")) == given


@pytest.mark.parametrize("delimiter", [".", "||", "\\E", "\\", "^", "[]", "\t"])
def test_delimiters_are_literal(spark, delimiter):
    given = delimiter.join(["D1", "a", "b"])
    got = texts(masking.mask_delimited(lines(spark, given), delimiter, [1]))
    assert got == [delimiter.join(["D1", "X", "b"])]


def test_empty_fields_are_kept(spark):
    assert texts(masking.mask_delimited(lines(spark, "D1,,a,,"), ",", [2])) == ["D1,,X,,"]


@pytest.mark.parametrize("delimiter", ["|", ",", "x", "||", "1", "ab"])
@pytest.mark.parametrize("columns", [(0,), (1, 2), (0, 2, 3, 6), (5, 6, 7, 8), (4,)])
def test_random_fields_equal_a_plain_split(spark, delimiter, columns):
    rng = random.Random(f"{delimiter}{columns}")
    alphabet = ["a", "Z", "7", "é", "-", "", delimiter, delimiter]
    given = ["".join(rng.choices(alphabet, k=rng.randrange(20))) for _ in range(60)]
    plain = str.maketrans(
        tx.LETTERS + tx.DIGITS, "X" * len(tx.LETTERS) + "9" * len(tx.DIGITS)
    )

    def expected(line):
        fields = line.split(delimiter)
        return delimiter.join(
            f.translate(plain) if i in columns else f for i, f in enumerate(fields)
        )

    def replaced(line):
        return sum(
            c in tx.LETTERS + tx.DIGITS
            for i, f in enumerate(line.split(delimiter)) if i in columns
            for c in f
        )

    frame = lines(spark, *given)
    got = texts(masking.mask_delimited(frame, delimiter, columns, row_prefix=None))
    assert got == [expected(line) for line in given]
    audit = masking.mask_audit(frame, [masking.delimited(delimiter, columns, row_prefix=None)])
    assert audit.first()["chars_masked"] == sum(map(replaced, given))


def test_unknown_structure_and_missing_delimiter_are_errors():
    with pytest.raises(ValueError):
        masking.Layout("X")
    with pytest.raises(ValueError):
        masking.Layout("D")
    assert masking.Layout("f").kind == "F"


def test_source_without_layout_is_an_error(spark):
    frame = masking.mask_by_layout(lines(spark, "abc"), [masking.fixed(src_pattern="^other")])
    with pytest.raises(Exception, match="no mask layout"):
        frame.collect()


def test_first_matching_layout_wins(spark):
    both = lines(spark, "D1|ab", src="x.csv").unionByName(lines(spark, "D1|ab", src="y.txt"))
    layouts = [
        masking.delimited("|", [1], src_pattern=r"\.csv$"),
        masking.fixed([(0, 0)], src_pattern=""),
    ]
    assert texts(masking.mask_by_layout(both, layouts)) == ["D1|XX", "X1|ab"]


def test_audit_counts(spark):
    frame = lines(spark, "abc12", "--", "a")
    row = masking.mask_audit(frame, [masking.fixed([(0, 3)])]).first()
    assert (row["rows"], row["rows_masked"], row["chars_masked"]) == (3, 2, 5)


def test_whitespace(spark):
    assert one(spark, "  A \t B  C\x1f ", tx.collapse_whitespace) == "A B C"
    spaces = [chr(c) for c in range(0x3001) if chr(c).isspace()]
    assert len(spaces) == 29
    assert one(spark, "x".join(["", *spaces, ""]), tx.collapse_whitespace) == " ".join("x" * 30)


def test_line_ends_of_a_text(spark):
    value = "a\x0bb\x0cc\u2028d\x85e\rf\ng\r\nh"
    assert len(one(spark, value, tx.text_lines)) == 4
    wide = one(spark, value, lambda c: tx.text_lines(c, True))
    assert wide == value.splitlines() and len(wide) == 8


@pytest.mark.parametrize("value", ["", "\n", "a", "a\n", "a\n\n", "\n\na", "\r\n\r\n", "a\rb\r"])
def test_lines_of_a_text_equal_splitlines(spark, value):
    assert one(spark, value, tx.text_lines) == value.splitlines()


def test_first_match_value_index_length(spark):
    got = one(spark, "😀bar FOO foo", lambda c: tx.first_match(c, "f(o)(o)", 2))
    assert [tuple(m) for m in got] == [("FOO", 6, 3, ["O", "O"])]


def test_paths(spark):
    archive = F.lit("C:\\a.zip")
    assert one(spark, "d/e/x.txt", tx.native_path) == "d\\e\\x.txt"
    assert one(spark, "d/e/x.txt", lambda c: tx.containing_path(archive, c)) == "C:\\a.zip\\d\\e"
    assert one(spark, "x.txt", lambda c: tx.containing_path(archive, c)) == "C:\\a.zip"


MONDAY = dt.date(2024, 1, 8)


def test_business_dates(spark):
    def dates(*args, **options):
        return [d.isoformat() for d in business_date_list(spark, *args, **options)]

    assert dates(MONDAY, 2) == []
    assert dates(MONDAY, 2, "business") == ["2024-01-04", "2024-01-05"]
    assert dates(MONDAY, 4) == ["2024-01-04", "2024-01-05"]
    assert dates(MONDAY, 0) == [] and dates(MONDAY, 0, "business") == []
    assert dates(dt.date(2024, 1, 7), 2) == ["2024-01-05"]
    holiday = [dt.date(2024, 1, 5)]
    assert dates(MONDAY, 2, "business", holiday) == ["2024-01-03", "2024-01-04"]
    assert dates(MONDAY, 4, "calendar", holiday) == ["2024-01-04"]
    assert len(dates(MONDAY, 250, "business")) == 250


def test_business_dates_default_is_today(spark):
    got = spark.range(1).select(business_dates(F.current_date(), 7).alias("d")).first()["d"]
    assert business_date_list(spark, None, 7) == got
    with pytest.raises(ValueError):
        business_dates(F.current_date(), -1)
    with pytest.raises(ValueError):
        business_dates(F.current_date(), 1, "weeks")
