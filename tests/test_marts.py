"""Report marts on hand-made Gold rows (cases the fixture cannot reach)."""


from incidentlake.operators import marts
from incidentlake.plans.dashboard import Selection, build_marts, filter_options

SCHEMA = (
    "attack_type string, severity_level string, protocol string, action_taken string, "
    "network_segment string, total_incidents bigint, avg_anomaly_score double, "
    "max_anomaly_score double, malware_detected_count bigint, malware_pct double, "
    "unique_source_networks bigint"
)


def gold(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def row(a, s="LOW", p="TCP", act="LOGGED", n=1, avg=10.0, mx=20.0, mal=0, srcs=1):
    return (a, s, p, act, "Segment A", n, avg, mx, mal, 100.0 * mal / n, srcs)


def test_top12_cut_keeps_largest_ascending(spark):
    g = gold(spark, [row(f"A{i:02d}", n=i + 1) for i in range(15)])
    out = marts.attack_volume(marts.filter_gold(g), 12).collect()
    assert [r.attack_type for r in out] == [f"A{i:02d}" for i in range(3, 15)]
    assert [r.total_incidents for r in out] == list(range(4, 16))


def test_filter_drops_nulls_and_respects_lists(spark):
    g = gold(spark, [row("X"), row(None), row("Y", s=None), row("Z", p=None), row("W", p="UDP")])
    assert sorted(r.attack_type for r in marts.filter_gold(g).collect()) == ["W", "X"]
    sel = marts.filter_gold(g, protocols=["UDP"]).collect()
    assert [r.attack_type for r in sel] == ["W"]
    assert marts.filter_gold(g, attacks=[]).count() == 0
    assert marts.is_empty(marts.filter_gold(g, attacks=[]))


def test_options_sorted_without_null(spark):
    g = gold(spark, [row("B"), row("A"), row(None), row("B", p="UDP")])
    opts = [tuple(r) for r in filter_options(g).collect()]
    assert opts == [("attack_type", "A"), ("attack_type", "B"), ("protocol", "TCP"),
                    ("protocol", "UDP"), ("severity_level", "LOW")]
    assert [r[0] for r in marts.dimension_options(g, "attack_type").collect()] == ["A", "B"]


def test_kpis_and_formatting(spark):
    g = gold(spark, [
        row("X", s="CRITICAL", n=1500, avg=10.0, mal=700, srcs=3),
        row("Y", s="LOW", n=10, avg=20.005, mal=1, srcs=4),
        row("X", s="CRITICAL", act="BLOCKED", n=2, avg=30.0, srcs=5),
    ])
    k = marts.kpis(marts.filter_gold(g))
    r = k.first()
    assert (r.total_incidents, r.distinct_attacks, r.total_malware, r.critical_count, r.distinct_networks) == (
        1512, 2, 701, 1502, 12)
    assert abs(r.avg_anomaly - 20.001666666) < 1e-6
    f = marts.kpis_formatted(k).first()
    assert (f.total_incidents, f.distinct_attacks, f.avg_anomaly) == ("1,512", "2", f"{r.avg_anomaly:.2f}")


def test_kpis_on_empty_selection(spark):
    g = gold(spark, [row("X")])
    r = marts.kpis(marts.filter_gold(g, attacks=["NONE"])).first()
    assert (r.total_incidents, r.distinct_attacks, r.avg_anomaly, r.critical_count) == (0, 0, None, 0)


def test_severity_action_order_and_unknown_levels(spark):
    g = gold(spark, [
        row("X", s="HIGH", act="LOGGED", n=2), row("X", s="LOW", act="BLOCKED", n=3),
        row("X", s="SEVERE", act="LOGGED", n=4), row("X", s="LOW", act=None, n=9),
    ])
    out = [tuple(r) for r in marts.severity_action(marts.filter_gold(g)).collect()]
    assert out == [("LOW", "BLOCKED", 3, 1), ("HIGH", "LOGGED", 2, 3), (None, "LOGGED", 4, None)]


def test_heatmap_fills_missing_cells(spark):
    g = gold(spark, [row("X", p="TCP", n=2), row("Y", p="UDP", n=3), row("X", p="TCP", act="B", n=1)])
    out = marts.heatmap(marts.filter_gold(g), ["TCP", "UDP"])
    assert out.columns == ["attack_type", "TCP", "UDP"]
    assert [tuple(r) for r in out.collect()] == [("X", 3, 0), ("Y", 0, 3)]
    fixed = marts.heatmap(marts.filter_gold(g), protocols=["ICMP", "TCP"])
    assert fixed.columns == ["attack_type", "ICMP", "TCP"]


def test_heatmap_cells_have_no_limit(spark):
    wide = spark.range(10_050).selectExpr("concat('A', id % 2) AS attack_type", "concat('p', id) AS protocol", "id AS total_incidents")
    out = marts.heatmap_cells(wide)
    assert out.count() == 2 * 10_050
    assert out.agg({"total_incidents": "sum"}).first()[0] == sum(range(10_050))
    assert out.where("total_incidents = 0").count() == 10_050 + 1


def test_empty_selection_builds_no_reports(spark):
    bundle = build_marts(gold(spark, [row("X", s="LOW")]), Selection(severities=["HIGH"]))
    assert set(bundle) == {"filtered"}


def test_severity_share_sums_to_100(spark):
    g = gold(spark, [row("X", s="LOW", n=1), row("X", s="HIGH", n=3)])
    out = marts.severity_share(marts.filter_gold(g)).collect()
    assert [(r.severity_level, r.grand_total, r.share_pct) for r in out] == [("HIGH", 4, 75.0), ("LOW", 4, 25.0)]


def test_malware_pct_half_even_and_label(spark):
    # 1 of 8 = 12.5% -> stays 12.5, label rounds half to even on the exact value
    g = gold(spark, [row("X", n=8, mal=1), row("Y", n=400, mal=49)])
    out = {r.attack_type: (r.pct, r.pct_label) for r in marts.malware_by_attack(marts.filter_gold(g)).collect()}
    assert out == {"X": (12.5, f"{12.5:.1f}%"), "Y": (12.25, f"{12.25:.1f}%")}


def test_top_incidents_limit_order_and_labels(spark):
    g = gold(spark, [row(f"A{i:02d}", n=1 + i % 7, avg=float(i)) for i in range(60)])
    out = marts.top_incidents(marts.filter_gold(g), 50, marts.DISPLAY_LABELS)
    assert out.columns[0] == "Tipo de Ataque" and len(out.columns) == 10
    rows = out.collect()
    assert len(rows) == 50
    keys = [(r["Total Incidentes"], r["Score Médio"]) for r in rows]
    assert keys == sorted(keys, reverse=True)


def test_build_marts_bundle(spark):
    g = gold(spark, [row("X", s="LOW"), row("Y", s="HIGH", p="UDP")])
    bundle = build_marts(g, Selection(severities=["LOW"]))
    assert set(bundle) >= {"kpis", "attack_volume", "severity_share", "heatmap", "top_incidents"}
    assert bundle["kpis"].first().total_incidents == 1
    assert bundle["filtered"].is_cached and bundle["kpis"].is_cached
    assert bundle["kpis_formatted"].first().total_incidents == "1"
    from incidentlake.plans.dashboard import release

    release(bundle)
    assert not bundle["filtered"].is_cached and not bundle["kpis"].is_cached


def test_anomaly_by_attack(spark):
    g = gold(spark, [row("X", avg=10.0, mx=50.0), row("X", avg=20.0, mx=70.0), row("Y", avg=40.0, mx=41.0)])
    out = [tuple(r) for r in marts.anomaly_by_attack(marts.filter_gold(g)).collect()]
    assert out == [("Y", 40.0, 41.0), ("X", 15.0, 70.0)]


def test_nulls_sort_last_in_descending_orders(spark):
    g = gold(spark, [row("X", avg=None, n=5), row("Y", avg=1.0, n=5), row("Z", avg=2.0, n=5)])
    out = [r.attack_type for r in marts.top_incidents(marts.filter_gold(g), 50).collect()]
    assert out == ["Z", "Y", "X"]
    anomaly = [r.attack_type for r in marts.anomaly_by_attack(marts.filter_gold(g)).collect()]
    assert anomaly == ["Z", "Y", "X"]
