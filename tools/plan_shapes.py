"""Print a markdown table of every catalog query's physical plan shape with
automatic broadcasts disabled (the shape the plans take on large inputs):
shuffles (of the query on stored stand-ins, and with the stand-ins built from
the driver tables), sort-merge joins, explicit broadcasts, scalar
subqueries (one-row constants), file scans and Python evaluation nodes,
counted from ``explain("formatted")`` (subquery plans included).

Usage: python tools/plan_shapes.py [sf_dir]
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from entiscore.plans.catalog import CATALOG  # noqa: E402
from entiscore.session import local_session, scratch_path  # noqa: E402
from entiscore.sources import fixtures as fx  # noqa: E402


def formatted_plan(df) -> str:
    """The formatted physical plan, subqueries included, as text."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def shape(df) -> dict[str, int]:
    plan = formatted_plan(df)

    def nodes(pattern):
        return len(re.findall(rf"^\(\d+\) {pattern}", plan, flags=re.M))

    return {
        "shuffles": nodes(r"Exchange\b"),
        "smj": nodes(r"SortMergeJoin"),
        "broadcasts": nodes(r"BroadcastExchange"),
        "subqueries": len(re.findall(r"^Subquery:\d+", plan, flags=re.M)),
        "scans": nodes(r"Scan (parquet|json|csv)"),
        "python": nodes(r"(BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas)"),
    }


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    whole = {name: shape(build(spark, sf))["shuffles"] for name, build in CATALOG.items()}
    fx.materialize(spark, sf, scratch_path(spark, "plan-shapes"))
    print("| query | shuffles | shuffles with stand-ins | sort-merge joins | explicit broadcasts | scalar subqueries | scans | python nodes |")
    print("|---|---|---|---|---|---|---|---|")
    for name, build in CATALOG.items():
        s = shape(build(spark, sf))
        print(f"| `{name}` | {s['shuffles']} | {whole[name]} | {s['smj']} | {s['broadcasts']} | {s['subqueries']} | {s['scans']} | {s['python']} |")
    spark.stop()


if __name__ == "__main__":
    main()
