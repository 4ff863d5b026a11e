"""Physical-plan properties the design relies on at scale."""

import io
import re
from contextlib import redirect_stdout

from pyspark.sql import Row

from wagelens import contract
from wagelens.operators.dedup import first_wins
from wagelens.plans import summaries as SM
from wagelens.sources import driver_tables as D

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_first_wins_is_a_hash_aggregate_with_partials(spark):
    rows = spark.createDataFrame([Row(k=1, valor=1.0, ord=2), Row(k=1, valor=2.0, ord=1)], "k int, valor double, ord long")
    plan = _plan(first_wins(rows, ["k"], ["valor"]))
    assert "partial_min_by" in plan and "HashAggregate" in plan
    assert "SortAggregate" not in plan


def _ancestors(tree: list[str], idx: int) -> list[str]:
    """Lines above ``idx`` with a smaller indentation (the parent chain)."""
    def indent(s):
        return len(s) - len(s.lstrip(" :|+-"))
    out, level = [], indent(tree[idx])
    for line in reversed(tree[:idx]):
        if indent(line) < level:
            out.append(line)
            level = indent(line)
    return out


def test_lineitem_is_never_the_broadcast_side(spark):
    plan = _plan(D.observations(spark, SF))
    tree, _, details = plan.partition("\n\n\n")
    ids = re.findall(r"\((\d+)\) Scan parquet\s*\n(?:.*\n)*?Location: .*lineitem", details)
    assert ids
    lines = tree.splitlines()
    for n in ids:
        idx = next(i for i, line in enumerate(lines) if re.search(rf"Scan parquet\s+\({n}\)", line))
        for parent in _ancestors(lines, idx):
            if "Join" in parent:
                break
            assert "BroadcastExchange" not in parent


def test_flagship_has_no_cartesian_product_and_prunes_partitions(spark):
    plan = _plan(SM.ratio_stats(contract.parts(spark, SF)))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "dynamicpruningexpression" in plan
    assert "PushedFilters: [IsNotNull(valor), IsNotNull(categoria_gasto), GreaterThan(valor,0.0)" in plan
