"""Physical-plan summary of every registered query (``python -m roomledger.plans.inspect SF_DIR``).

For each query: shuffles (hash/range/single-partition exchanges), broadcasts, join strategies,
single-partition exchanges (these include the one-row final merge of every global aggregate and
the windows over measured-small dimension members), Python UDFs, and whether filters reached a
parquet scan. Gold queries materialise silver and the dimensions while being built (that is how
they are sized), so cached sub-plans are printed, and counted, inside the final plan.
"""

from __future__ import annotations

import io
import re
import sys
from contextlib import redirect_stdout

from pyspark.sql import DataFrame

OPERATORS = {
    "shuffles": r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange RoundRobinPartitioning|Exchange SinglePartition",
    "single_partition": r"Exchange SinglePartition",
    "broadcasts": r"BroadcastExchange",
    "broadcast_hash_joins": r"BroadcastHashJoin",
    "sort_merge_joins": r"SortMergeJoin",
    "nested_loop_joins": r"BroadcastNestedLoopJoin|CartesianProduct",
    "python_udfs": r"BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas",
}


def plan_text(df: DataFrame) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("extended")
    text = buf.getvalue()
    return text[text.index("== Physical Plan ==") :]


def summarize(df: DataFrame) -> dict[str, int | str]:
    text = plan_text(df)
    out: dict[str, int | str] = {k: len(re.findall(p, text)) for k, p in OPERATORS.items()}
    out["pushed_filters"] = "yes" if re.search(r"PushedFilters: \[[^\]]+\]", text) else "no"
    return out


def report(spark, sf_dir: str) -> str:
    from roomledger.plans.catalog import queries

    lines = [
        "| query | shuffles | single-partition | broadcasts | BHJ | SMJ | NLJ/cartesian | Python UDF | pushed filters |",
        "|---|---|---|---|---|---|---|---|---|",
    ]
    for name, fn in queries().items():
        s = summarize(fn(spark, sf_dir))
        lines.append(
            f"| {name} | {s['shuffles']} | {s['single_partition']} | {s['broadcasts']} | {s['broadcast_hash_joins']} | "
            f"{s['sort_merge_joins']} | {s['nested_loop_joins']} | {s['python_udfs']} | {s['pushed_filters']} |"
        )
    return "\n".join(lines)


if __name__ == "__main__":
    from roomledger.session import local_session

    print(report(local_session(8), sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"))
