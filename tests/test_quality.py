import pytest

from eventlake.errors import DataQualityError, EmptyTableError
from eventlake.operators import quality

EXPECTED = {
    "null_user_id": 3,
    "invalid_event_type": 1,
    "null_product_id": 3,
    "negative_price": 1,
    "unpriced_purchase": 2,
    "nonfinite_price": 1,
}


def test_report_counts_every_rule(edge_bronze):
    row = quality.quality_report(edge_bronze).first().asDict()
    assert row.pop("passed") is False
    assert row == EXPECTED


def test_issues_are_the_report_in_long_form(edge_bronze):
    issues = quality.quality_issues(quality.quality_report(edge_bronze))
    assert {row.rule: row.violations for row in issues.collect()} == EXPECTED


def test_gate_names_the_violated_rules(edge_bronze):
    with pytest.raises(DataQualityError) as caught:
        quality.check_quality(edge_bronze)
    assert caught.value.violations == EXPECTED
    sound = quality.check_quality(edge_bronze.filter("offset <= 5"))
    assert set(sound.values()) == {0}


def test_a_null_type_breaks_no_rule(edge_bronze):
    report = quality.quality_report(edge_bronze.filter("offset = 9")).first()
    assert report.passed


def test_the_report_of_no_rows_passes(edge_bronze):
    assert quality.quality_report(edge_bronze.filter("false")).first().passed


def test_violations_are_tagged_per_row(edge_bronze):
    tags = {r.offset: r.violated_rules for r in quality.tag_violations(edge_bronze).collect()}
    assert tags[0] == [] and tags[9] == [] and tags[14] == []
    assert tags[11] == ["unpriced_purchase"]
    assert tags[13] == ["nonfinite_price"]
    assert tags[15] == ["null_user_id", "null_product_id"]


def test_row_gates(spark):
    quality.require_rows(a=spark.range(1))
    with pytest.raises(EmptyTableError, match="b"):
        quality.require_rows(a=spark.range(1), b=spark.range(0))
    assert quality.enough_to_train(spark.range(100))
    assert not quality.enough_to_train(spark.range(99))
    with pytest.warns(UserWarning, match="fewer than 10"):
        assert not quality.enough_to_train(spark.range(9))
