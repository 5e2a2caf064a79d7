"""What the star's plans carry from task to task."""

from ledgerwright.plans import registry


def test_texts_of_facts_are_made_after_all_joins(spark, sf):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = registry.queries()["star_txn"](spark, sf)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    joins = [i for i, line in enumerate(plan) if "Join Inner" in line]
    assert joins and all(i < joins[0] for i, line in enumerate(plan) if "concat" in line)


def test_product_share_sums_before_it_joins_products(spark, sf):
    plan = registry.queries()["kpi03_product_share"](spark, sf)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    names = [i for i, line in enumerate(plan) if "Aggregate" in line and "product_name" in line]
    sums = [i for i, line in enumerate(plan) if "Aggregate" in line and "product_sk" in line and "product_name" not in line]
    # the facts' sums stand below the products' join, and only rows of them meet the names
    assert len(sums) == 2 and names and min(sums) > names[0]
