import pytest

from tablevault import Checks, verify, verify_clone

EXACT = Checks()
SAMPLE = Checks(full_diff=False)
COUNT = Checks(full_diff=False, sample=False)
PRINT = Checks(full_diff=False, sample=False, fingerprint=True)
PROFILE = Checks(full_diff=False, sample=False, row_count=False, profile=True)
ALL = Checks(fingerprint=True, profile=True)


@pytest.mark.parametrize("checks", [EXACT, SAMPLE, COUNT, PRINT, PROFILE, ALL])
def test_a_copy_in_another_layout_passes(sample, checks):
    report = verify(sample, sample.repartition(3).coalesce(2), checks).first()
    assert report.passed
    assert (report.source_rows, report.target_rows) in [(3, 3), (None, None)]
    assert verify_clone(sample, sample, checks)


@pytest.mark.parametrize("checks", [EXACT, SAMPLE, COUNT, PRINT, PROFILE, ALL])
def test_a_lost_row_fails(sample, checks):
    assert not verify(sample, sample.filter("id <> 2"), checks).first().passed
    assert not verify_clone(sample, sample.filter("id <> 2"), checks)


@pytest.mark.parametrize("checks", [EXACT, SAMPLE, PRINT, PROFILE, ALL])
def test_a_changed_value_fails(sample, checks):
    changed = sample.selectExpr("id", "name", "if(id = 2, 201, value) AS value")
    assert not verify(sample, changed, checks).first().passed


@pytest.mark.parametrize("checks", [EXACT, SAMPLE, PRINT])
def test_swapped_values_fail(sample, checks):
    swapped = sample.selectExpr("id", "name", "CASE id WHEN 1 THEN 200 WHEN 2 THEN 100 ELSE value END AS value")
    assert not verify(sample, swapped, checks).first().passed


@pytest.mark.parametrize("checks", [EXACT, SAMPLE, PRINT])
def test_a_row_doubled_in_place_of_another_fails(sample, checks):
    doubled = sample.filter("id <> 3").union(sample.filter("id = 1"))
    assert not verify(sample, doubled, checks).first().passed


@pytest.mark.parametrize("checks", [EXACT, SAMPLE, COUNT, PRINT])
def test_two_equal_rows_against_one_fail(sample, checks):
    assert not verify(sample.union(sample), sample, checks).first().passed


def test_report_counts(sample):
    damaged = sample.filter("id <> 2").union(sample.filter("id = 3"))
    report = verify(sample, damaged, ALL).first()
    assert report.asDict() == {
        "schema_match": True, "source_rows": 3, "target_rows": 3, "missing_rows": 1,
        "extra_rows": 1, "fingerprint_match": False, "profile_match": False, "passed": False,
    }


def test_a_difference_outside_the_sample_is_not_seen(sample):
    changed = sample.selectExpr("id", "name", "if(id = 3, 0, value) AS value")
    few = Checks(full_diff=False, sample_size=2)
    assert verify(sample, changed, few).first().passed
    assert not verify(sample, changed, SAMPLE).first().passed


def test_switched_off_checks_do_not_decide(sample):
    less = sample.filter("id <> 2")
    nothing = Checks(row_count=False, sample=False, full_diff=False)
    assert verify(sample, less, nothing).first().passed


def test_schema_mismatch_fails_with_counts(sample):
    other = sample.selectExpr("bigint(id) AS id", "name", "value")
    report = verify(sample, other).first()
    assert not report.schema_match and not report.passed
    assert (report.source_rows, report.target_rows, report.missing_rows) == (3, 3, None)


@pytest.mark.parametrize("checks", [EXACT, SAMPLE, COUNT, PRINT, PROFILE, ALL])
def test_empty_tables_pass(sample, checks):
    assert verify(sample.limit(0), sample.filter("id > 99"), checks).first().passed


def test_maps(spark):
    a = spark.sql("SELECT map('a', 1, 'b', 2) m")
    assert verify_clone(a, spark.sql("SELECT map('b', 2, 'a', 1) m"), ALL)
    assert not verify_clone(a, spark.sql("SELECT map('b', 3, 'a', 1) m"), EXACT)


def test_a_check_that_cannot_run_fails(spark, sample):
    broken = sample.selectExpr("id", "name", "int(raise_error('lost')) AS value")
    assert verify_clone(sample, broken) is False
