"""Print the physical plans of the main stages (after one execution, so AQE's
final plan is shown).

    python tools/show_plans.py [sf_dir] > PLANS.txt
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from alloy.operators import bronze as B
    from alloy.operators import silver as S
    from alloy.operators import validate as V
    from alloy.plans import catalog
    from alloy.session import get_spark
    from alloy.sources import fixture as FX

    spark = get_spark("local[8]", shuffle_partitions=8)
    sc = catalog.scenario(spark, sf)
    stages = {
        "header promotion (landed grid -> raw frame)": FX.landed_sheet(spark, sf, 1),
        "validation report over the flagged frame": V.report(V.flag(V.filter_creator_id(FX.landed_sheet(spark, sf, 1)))),
        "bronze build with watermark filter (run 2)": B.build_bronze(sc.s2.regular, sc.run2, sc.watermarks2)[0],
        "bronze dedup (first row per raw hash)": B.dedup_first(B.build_bronze(sc.s1.valid, sc.run1, None)[0]),
        "latest per session over all bronze": S.latest_per_session(sc.bronze1.unionByName(sc.bronze2)),
        "silver MERGE (run-1 silver + source of both runs)": S.upsert(sc.silver1, sc.source12),
    }
    for name, df in stages.items():
        df.collect()  # execute this DataFrame's own plan so AQE's final plan is shown (small sf only)
        print(f"== {name} ==")
        print(df._jdf.queryExecution().executedPlan().toString())


if __name__ == "__main__":
    main()
