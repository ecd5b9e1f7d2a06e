import pytest

from tagweave.sources.taxonomy import Taxonomy, parse_source_rule, taxonomy_frame


def build(spark, values, source="selectTable=t;selectField=a|b", **options):
    return Taxonomy(taxonomy_frame(spark, [(7, "tag", source, values)]), **options)


@pytest.mark.parametrize("limit", [10_000, 0], ids=["kept", "table"])
def test_source_rule_and_values(spark, rows, limit):
    tags = build(spark, [("x", "0-9"), ("y", "10-19")], limit=limit)
    rule = tags.source_rule(7)
    assert (rule.table, rule.fields) == ("t", ("a", "b"))
    assert rows(tags.code_rules(7).frame) == [("x", "0-9"), ("y", "10-19")]
    assert rows(tags.band_rules(7).frame) == [("x", 0, 9), ("y", 10, 19)]
    assert tags.code_rules(7).rows == (2 if limit else None)


@pytest.mark.parametrize("limit", [10_000, 0], ids=["kept", "table"])
def test_missing_and_empty_source_rules_name_the_tag(spark, limit):
    tags = build(spark, [("x", "1-2")], source="", limit=limit)
    with pytest.raises(ValueError, match="tag 7"):
        tags.source_rule(7)
    with pytest.raises(ValueError, match="tag 99"):
        tags.source_rule(99)
    with pytest.raises(ValueError, match="tag 5 has a malformed"):
        parse_source_rule(5, "table:t")


@pytest.mark.parametrize("limit", [10_000, 0], ids=["kept", "table"])
@pytest.mark.parametrize("rule", ["5", "a-b", "9-1", "1-2-3", "1-99999999999", "", "+1-10",
                                  "-1-10", None, "1-10\n", "\n1-10", "1-\n10"])
def test_malformed_ranges_raise(spark, rule, limit):
    with pytest.raises(ValueError, match="malformed"):
        build(spark, [("x", rule)], limit=limit).band_rules(7)


@pytest.mark.parametrize("limit", [10_000, 0], ids=["kept", "table"])
def test_overlapping_ranges_raise_unless_allowed(spark, rows, limit):
    for values in ([("x", "0-9"), ("y", "9-12")], [("x", "3-3"), ("x", "3-3")],
                   [("x", "0-99"), ("y", "40-50"), ("z", "100-101")]):
        tags = build(spark, values, limit=limit)
        with pytest.raises(ValueError, match="tag 7 has overlapping"):
            tags.band_rules(7)
        assert tags.band_rules(7, allow_overlap=True).frame.count() == len(values)
    apart = build(spark, [("x", " 0 - 9"), ("y", "10-12 ")], limit=limit)
    assert rows(apart.band_rules(7).frame) == [("x", 0, 9), ("y", 10, 12)]


@pytest.mark.parametrize("limit", [10_000, 0], ids=["kept", "table"])
def test_a_code_with_two_names_raises(spark, limit):
    tags = build(spark, [("x", "1"), ("y", "2"), ("z", "1")], limit=limit)
    with pytest.raises(ValueError, match="tag 7 has duplicate"):
        tags.code_rules(7)


@pytest.mark.parametrize("limit", [10_000, 0], ids=["kept", "table"])
def test_a_tag_without_values_raises(spark, limit):
    tags = build(spark, [("x", "1")], limit=limit)
    for ask in (tags.code_rules, tags.band_rules):
        with pytest.raises(ValueError, match="no values"):
            ask(8)


def test_missing_taxonomy_columns_are_named(spark):
    with pytest.raises(ValueError, match="rule"):
        Taxonomy(spark.createDataFrame([(1,)], "id int"))
