"""Incremental load by Structured Streaming (availableNow trigger)."""

import json
import os
import tempfile

from wagelens.sources.warehouse import Warehouse
from wagelens.streaming import incremental

from test_golden import PAYLOADS


def _write(d, code):
    with open(os.path.join(d, f"{code}.json"), "w", encoding="utf-8") as fh:
        json.dump(PAYLOADS[code], fh, ensure_ascii=False)


def test_stream_loads_new_files(spark):
    landing = tempfile.mkdtemp(prefix="wagelens-stream-in-")
    root = tempfile.mkdtemp(prefix="wagelens-stream-wh-") + "/wh"
    ckpt = tempfile.mkdtemp(prefix="wagelens-stream-ckpt-")
    _write(landing, 50913)
    q = incremental.start(spark, landing, root, ckpt)
    q.awaitTermination(120)
    counts = {r.tabla: r.filas for r in Warehouse(spark, root).counts().collect()}
    assert counts["T_precios"] == 5          # IPC only: general x4 dates (one from another measure) + food
    _write(landing, 25171)
    q = incremental.start(spark, landing, root, ckpt)
    q.awaitTermination(120)
    counts = {r.tabla: r.filas for r in Warehouse(spark, root).counts().collect()}
    assert counts["T_precios"] == 7


def test_view_kept_by_the_stream_equals_the_full_summaries(spark):
    """Three batches: the merged moments give what the facts give, and each batch reads its own facts alone."""
    import math

    from wagelens.plans import gold as G
    from wagelens.plans import summaries as SM
    from wagelens.streaming.gold_view import GoldView

    root = tempfile.mkdtemp(prefix="wagelens-stream-wh-") + "/wh"
    ckpt, landing = tempfile.mkdtemp(prefix="wagelens-stream-ckpt-"), tempfile.mkdtemp(prefix="wagelens-stream-in-")
    codes = sorted(PAYLOADS)
    for batch in (codes[:2], codes[2:5], codes[5:]):
        for code in batch:
            _write(landing, code)
        incremental.start(spark, landing, root, ckpt, keep_view=True).awaitTermination(120)
    wh = Warehouse(spark, root)
    view, live = GoldView(wh), wh.live()
    assert len(live) == 3 and view.refresh() == []
    assert all(f"carga={live[-1]}" in f for f in view.batch(live[-1], live).salarios.inputFiles())
    full, kept = G.gold_parts(wh.star()), view.moments()
    checks = [lambda p: SM.ratio_stats(p), lambda p: SM.wage_trend_region(p), lambda p: SM.purchasing_power_rank(p), lambda p: SM.region_summary(p),
              lambda p: SM.dashboard_kpis(p), lambda p: SM.wage_trend_region(p, years=[2022])]
    rows = 0
    for check in checks:
        a, b = (sorted(map(tuple, check(p).collect()), key=str) for p in (full, kept))
        assert len(a) == len(b)
        rows += len(a)
        for x, y in zip(a, b):
            assert all(u == v or isinstance(u, float) and math.isclose(u, v, rel_tol=1e-12) for u, v in zip(x, y))
    assert rows > 5
    facts = kept.wages.inputFiles()
    assert facts and all("/_view/" in f for f in facts)
