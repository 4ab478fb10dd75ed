"""Reading processed tables by their header."""

import pytest

from wardline.sources.tables import read_processed_csv

SCHEMA = "idx int, a int, b string, date string"


@pytest.mark.parametrize("header", ["idx|a|b|date", "idx|b|date|a", "date|idx|a|b", "|a|b|date", "other|b|a|date", "idx|more|a|b|date"])
def test_columns_are_found_by_name(spark, tmp_path, header):
    values = {"idx": "9", "a": "1", "b": "x", "date": "2020-01-02 03:04:05", "": "9", "other": "9", "more": "y"}
    (tmp_path / "t.csv").write_text(header + "\n" + "|".join(values[n] for n in header.split("|")) + "\n")
    table = read_processed_csv(spark, str(tmp_path), SCHEMA)
    assert table.columns == ["a", "b", "date"]
    row = table.first()
    assert (row.a, row.b, str(row.date)) == (1, "x", "2020-01-02 03:04:05")


def test_wrong_headers_are_errors(spark, tmp_path):
    (tmp_path / "t.csv").write_text("idx|a|date\n1|2|2020-01-01\n")
    with pytest.raises(ValueError, match="'b'"):
        read_processed_csv(spark, str(tmp_path), SCHEMA)
    (tmp_path / "t.csv").write_text("idx|a|b|date\n1|2|x|2020-01-01\n")
    (tmp_path / "u.csv").write_text("idx|b|a|date\n1|x|2|2020-01-01\n" * 1)
    with pytest.raises(Exception, match="header|CSV"):
        read_processed_csv(spark, str(tmp_path), SCHEMA).collect()
