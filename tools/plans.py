"""Print the formatted physical plans of the headline queries (after execution,
so the adaptive plan is final).

    python tools/plans.py [--sf /root/testdata/sf0.01] [name ...] > plans.txt
"""

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DEFAULT = ["ingredient_tokens", "token_edit_distance", "similar_products", "similar_users",
           "rating_matrix", "rating_histogram", "recommend_sql"]


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    from sheen.plans.registry import QUERIES
    from sheen.session import local_session
    spark = local_session()
    for name in args.names or DEFAULT:
        df = QUERIES[name](spark, args.sf)
        df.write.format("noop").mode("overwrite").save()
        print(f"==================== {name}")
        df.explain("formatted")
    spark.stop()


if __name__ == "__main__":
    main()
