"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one line of JSON.

`queries` has the first run of each query in the session (cold) and `value` their sum; `warm` has
the median of three further runs. BENCH_WARM=0 leaves these out.
"""

import json
import os
import time
from statistics import median

from ledgerwright import session
from ledgerwright.plans import registry

QUERIES = (
    "kpi01_top_customers", "kpi02_branch_monthly", "kpi03_product_revenue", "kpi04_dormant_accounts", "kpi05_suspicious_60min", "kpi06_customer_segments", "kpi07_branch_ranking", "kpi08_kyc_exposure",
    "kpi09_refund_by_product", "kpi10_dq_scorecard", "kpi13_new_activations", "scd2_merge", "asof_join", "fact_upsert", "best_copy", "referential_check", "range_self_join", "pivot_month_region", "shape_profile",
)


def main() -> None:
    sf, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = session.build(f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry.queries()
    spark.read.parquet(f"{sf}/orders.parquet").count()

    def seconds(name: str) -> float:
        began = time.time()
        queries[name](spark, sf).write.format("noop").mode("overwrite").save()
        return round(time.time() - began, 3)

    took = {name: seconds(name) for name in QUERIES}
    again = {name: median(seconds(name) for _ in range(3)) for name in QUERIES} if os.environ.get("BENCH_WARM", "1") == "1" else {}
    total = {"metric": "headline_queries_total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took}
    print(json.dumps(total | {"warm": again, "warm_total": round(sum(again.values()), 3), "sf": sf}))


if __name__ == "__main__":
    main()
