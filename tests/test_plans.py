"""Plans keep what scale needs: no products of tables, no Python in column rules, filters at the scan."""

import __spark_entry__ as entry
from foliospark import plans

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().toString()


def test_no_cartesian_products(spark):
    for name in ("related_concepts", "taxonomy_decisions", "family_assignments", "section_refs"):
        assert "CartesianProduct" not in plan(plans.QUERIES[name](spark, SF)), name


def test_column_rules_stay_in_the_jvm(spark):
    for name in ("clean_pages", "heading_candidates", "normalized_sections", "precheck_decisions", "merged_concepts", "related_concepts", "argument_maps", "run_metrics"):
        text = plan(plans.QUERIES[name](spark, SF))
        assert "Python" not in text and "Pandas" not in text, name


def test_scans_read_only_what_they_need(spark):
    text = plan(plans.QUERIES["concept_index"](spark, SF))
    assert "l_extendedprice" not in text.split("== Physical Plan ==")[1]


def test_entry_and_registry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
