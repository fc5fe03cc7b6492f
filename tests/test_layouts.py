"""The record layouts and the checks of layout tables."""

import pytest

from slotline.checks import layout as checks
from slotline.layouts import CLAIM_HEADER, CLAIM_LINE, LAYOUTS
from slotline.layouts.model import LAYOUT_TABLE, layout_table


@pytest.mark.parametrize("layout", LAYOUTS, ids=lambda layout: layout.record_type)
def test_slots_are_in_order_and_cover_no_constant(layout):
    blank, end = layout.blank_record(), 0
    assert len(blank) == layout.width
    for slot in layout.slots:
        assert slot.start > end
        assert blank[slot.start - 1 : slot.end].strip() == ""
        end = slot.end
    assert end <= layout.width


def test_constant_bytes_add_up():
    for layout, zeros, data in ((CLAIM_HEADER, 1864, 392), (CLAIM_LINE, 835, 296)):
        assert layout.blank_record().count("0") == zeros
        assert sum(slot.width for slot in layout.slots) == data


def test_pieces_merge_neighbouring_constants():
    assert (len(CLAIM_HEADER.pieces()), len(CLAIM_LINE.pieces())) == (80, 45)


def test_own_layouts_pass_their_checks(spark):
    summary = {row.record_type: row for row in checks.summary(layout_table(spark, LAYOUTS)).collect()}
    for layout in LAYOUTS:
        row = summary[layout.record_type]
        assert row.passed and row.length_difference == 0
        assert (row.first_position, row.last_position, row.total_length) == (1, layout.width, layout.width)


def fields(spark, *rows):
    full = [("T", name, start, end, side, pad, char, line) for line, (name, start, end, side, pad, char) in enumerate(rows)]
    return spark.createDataFrame(full, LAYOUT_TABLE)


def found(frame):
    return sorted((row.issue, row.field_name, row.first_position, row.last_position, row["size"]) for row in frame.collect())


def test_gap_overlap_and_length(spark):
    gap = fields(spark, ("A", 1, 3, "RPAD", 3, " "), ("B", 5, 6, "RPAD", 2, " "))
    assert found(checks.gaps_and_overlaps(gap)) == [("GAP", "B", 4, 4, 1)]
    overlap = fields(spark, ("A", 1, 3, "RPAD", 3, " "), ("B", 3, 6, "RPAD", 4, " "))
    assert found(checks.gaps_and_overlaps(overlap)) == [("OVERLAP", "B", 3, 3, 1)]
    length = fields(spark, ("A", 1, 3, "RPAD", 2, " "))
    assert found(checks.length_mismatches(length)) == [("LENGTH_MISMATCH", "A", 1, 3, -1)]


def test_first_of_repeated_fields_wins(spark):
    twice = fields(spark, ("A", 1, 3, "RPAD", 3, " "), ("A", 1, 3, "LPAD", 9, "0"), ("B", 1, 3, "RPAD", 3, " "))
    assert sorted((row.field_name, row.line) for row in checks.dedupe(twice).collect()) == [("A", 0), ("B", 2)]


def test_padding_warnings(spark):
    mixed = fields(
        spark,
        ("X-DATE", 1, 8, "LPAD", 8, "0"),
        ("X-NUM", 9, 10, "RPAD", 2, "0"),
        ("EOMB-AMT-1", 11, 12, "LPAD", 2, " "),
        ("NAME", 13, 14, "RPAD", 2, " "),
    )
    assert [x[1] for x in found(checks.padding_warnings(mixed))] == ["EOMB-AMT-1", "X-NUM"]
    row = checks.summary(mixed).collect()[0]
    assert (row.errors, row.warnings, row.passed) == (0, 2, True)


def test_drift_follows_wrong_pads(spark):
    drift = fields(spark, ("A", 1, 3, "RPAD", 3, " "), ("B", 4, 10, "RPAD", 2, " "), ("C", 11, 12, "RPAD", 8, " "), ("D", 13, 13, "RPAD", 1, " "))
    got = sorted((row.field_name, row.mismatch, row["shift"]) for row in checks.width_drift(drift).collect())
    assert got == [("A", 0, 0), ("B", -5, 0), ("C", 6, -5), ("D", 0, 1)]
