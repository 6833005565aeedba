"""Replay step by step, reverse replay, intervals, transitions, gate."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelforge.functions import expr as E
from panelforge.operators import cdc, checks, keyed, temporal, tree
from panelforge.plans import replay, reverse, timeline
from panelforge.schemas import COMPANY_FIELDS, EMPRESA, ESTABLISHMENT_FIELDS, ESTABLISHMENT_KEY, FISCAL_FIELDS, MUNIC, PARTNER_FIELDS, PANEL_COLUMNS, PARTNER_ZERO, SIMPLES, SOCIOS, SPECS, TableSpec, ESTABELECIMENTO
from panelforge.streaming.periods import Periods

EST = T.StructType([ESTABELECIMENTO[c] for c in [*ESTABLISHMENT_KEY, *ESTABLISHMENT_FIELDS]])


def est(root, ordem, status=2, uf="SP", city=1):
    made = {"situacao_cadastral": status, "uf": uf, "municipio": city}
    return (root, ordem, "00", *[made.get(c) for c in ESTABLISHMENT_FIELDS])


def company(root, capital):
    return (root, "n", 1, 1, capital, 1, None)


def events(spark, table, rows, month="2023-06"):
    """rows: (key tuple, kind, values by name)."""
    spec = SPECS[table]
    types = {f.name: f.dataType for s in (EST, EMPRESA, SIMPLES) for f in s} | {c: T.IntegerType() for c in PARTNER_FIELDS}
    image = T.StructType([T.StructField(c, types[c]) for c in spec.tracked])
    schema = T.StructType([*[T.StructField(k, T.StringType()) for k in spec.keys], T.StructField("tipo_alteracao", T.StringType()), T.StructField("novo", image), T.StructField("mes_referencia", T.StringType())])
    return spark.createDataFrame([(*k, kind, None if v is None else tuple(v.get(c) for c in spec.tracked), month) for k, kind, v in rows], schema)


def run(spark, establishments, ledger, companies=(), partners=(), fiscal=(), end="2023-06", states=None):
    tables = {
        "estabelecimento": spark.createDataFrame(list(establishments), EST), "empresa": spark.createDataFrame(list(companies), EMPRESA), "socios": spark.createDataFrame(list(partners), SOCIOS),
        "simples": spark.createDataFrame(list(fiscal), SIMPLES), "munic": spark.createDataFrame([(1, "City", 3550308)], MUNIC),
    }
    full = {t: events(spark, t, []) for t in SPECS} | ledger
    panel, held = replay.reconstruct_panel(spark, tables, full, "2023-05", end, states)
    assert panel.columns == ["reference_month", *PANEL_COLUMNS]
    # without a step a month the result is the same
    at_once, also_held = timeline.panel_by_intervals(spark, tables, full, "2023-05", end, states)
    assert at_once.columns == panel.columns and sorted(map(repr, at_once.collect())) == sorted(map(repr, panel.collect()))
    assert sorted(map(repr, also_held.collect())) == sorted(map(repr, held.collect()))
    return {(r["reference_month"], r["cnpj_basico"], r["cnpj_ordem"]): r for r in panel.collect()}, held


def test_establishment_steps(spark):
    ledger = {"estabelecimento": events(spark, "estabelecimento", [
        (("1", "1", "00"), "DELETE", None), (("1", "2", "00"), "UPDATE", {"situacao_cadastral": 8, "uf": "RJ"}), (("9", "9", "00"), "UPDATE", {"situacao_cadastral": 8}),
        (("1", "4", "00"), "INSERT", {"situacao_cadastral": 2, "municipio": 1}), (("1", "3", "00"), "INSERT", {"situacao_cadastral": 5}), (("2", "1", "00"), "INSERT", {"situacao_cadastral": 2}),
    ])}
    got, _ = run(spark, [est("1", "1"), est("1", "2"), est("1", "3")], ledger, [company("1", 10.0), company("2", 20.0)])
    june = {k[1:]: r for k, r in got.items() if k[0] == "2023-06"}
    assert june.keys() == {("1", "2"), ("1", "3"), ("1", "4"), ("2", "1")}
    assert june["1", "2"]["situacao_cadastral"] == 8 and june["1", "2"]["municipio"] is None
    assert june["1", "3"]["situacao_cadastral"] == 2  # the key is there already
    assert june["1", "4"]["capital_social"] == 10.0 and june["1", "4"]["cd_mun"] == 3550308  # from a sibling
    assert june["2", "1"]["capital_social"] == 20.0 and june["2", "1"]["qtde_socios"] == 0  # from the baseline


def test_company_fiscal_and_partner_steps(spark):
    ledger = {
        "empresa": events(spark, "empresa", [(("1",), "UPDATE", {"capital_social": 11.0}), (("2",), "DELETE", None)]),
        "simples": events(spark, "simples", [(("1",), "DELETE", None)]),
        "socios": events(spark, "socios", [(("1",), "DELETE", None)]),
    }
    partners = [("1", 2, "a", None, 5, 20200101, None, None, None, None, 4)]
    got, _ = run(spark, [est("1", "1"), est("2", "1"), est("2", "2")], ledger, [company("1", 10.0)], partners, [("1", "S", 1, 2, "N", 3, 4)])
    assert got["2023-05", "1", "1"]["qtde_socios"] == 1 and got["2023-05", "1", "1"]["opcao_pelo_simples"] == "S"
    assert [k for k in got if k[0] == "2023-06"] == [("2023-06", "1", "1")]
    row = got["2023-06", "1", "1"]
    assert row["capital_social"] == 11.0 and all(row[c] is None for c in FISCAL_FIELDS)
    assert row["qtde_socios"] == 0 and row["qtde_administradores"] == 0 and row["min_faixa_etaria"] is None


def test_filter_is_on_the_output_alone(spark):
    move = lambda uf, month: events(spark, "estabelecimento", [(("1", "1", "00"), "UPDATE", {"uf": uf})], month)
    ledger = {"estabelecimento": move("RJ", "2023-06").unionByName(move("SP", "2023-07"))}
    got, _ = run(spark, [est("1", "1")], ledger, end="2023-07", states="SP,MG")
    assert {k[0] for k in got} == {"2023-05", "2023-07"}


def test_root_that_was_away_has_its_first_values(spark):
    e = lambda kind, month: events(spark, "estabelecimento", [(("1", "1", "00"), kind, {"situacao_cadastral": 2})], month)
    ledger = {"estabelecimento": e("DELETE", "2023-06").unionByName(e("INSERT", "2023-07")), "empresa": events(spark, "empresa", [(("1",), "UPDATE", {"capital_social": 99.0})])}
    got, _ = run(spark, [est("1", "1")], ledger, [company("1", 10.0)], end="2023-07")
    assert got["2023-07", "1", "1"]["capital_social"] == 10.0


def test_root_that_changes_all_establishments_begins_again_unless_asked(spark):
    july = [(("1", "1", "00"), "DELETE", None), (("1", "2", "00"), "INSERT", {"situacao_cadastral": 2})]
    ledger = {t: events(spark, t, []) for t in SPECS} | {"estabelecimento": events(spark, "estabelecimento", july, "2023-07"), "empresa": events(spark, "empresa", [(("1",), "UPDATE", {"capital_social": 99.0})])}
    tables = {"estabelecimento": spark.createDataFrame([est("1", "1")], EST), "empresa": spark.createDataFrame([company("1", 10.0)], EMPRESA), "socios": spark.createDataFrame([], SOCIOS), "simples": spark.createDataFrame([], SIMPLES), "munic": spark.createDataFrame([], MUNIC)}
    for replayed in (replay.reconstruct_panel, timeline.panel_by_intervals):
        for asked, capital in (({}, 10.0), ({"from_leaving": True}, 99.0)):
            panel, _ = replayed(spark, tables, ledger, "2023-05", "2023-07", **asked)
            assert [(r["cnpj_ordem"], r["capital_social"]) for r in panel.where("reference_month = '2023-07'").collect()] == [("2", capital)]


def test_quarantined_roots_have_no_company_values_in_any_month(spark):
    got, held = run(spark, [est("1", "1")], {"empresa": events(spark, "empresa", [(("1",), "UPDATE", {"capital_social": 7.0})])}, [company("1", 10.0), company("1", 11.0)], fiscal=[("1", "S", 1, 2, "N", 3, 4)])
    assert held.first()["motivo"] == "Conflict in retained company fields: capital_social (2) "
    assert all(r[c] is None for r in got.values() for c in [*COMPANY_FIELDS, *FISCAL_FIELDS]) and len(got) == 2


def test_intervals_replay_what_the_steps_do(spark):
    """Random ledgers of four months: keys and roots that come, go and come back, events of what is not there, companies that end."""
    rng = random.Random(8)
    months, roots = ["2023-06", "2023-07", "2023-08", "2023-09"], [str(k) for k in range(80)]
    ledger = {}
    for table, share in (("estabelecimento", 0.35), ("empresa", 0.2), ("simples", 0.25), ("socios", 0.25)):
        made = None
        for month in months:
            rows = []
            for root in roots:
                for key in [(root, o, "00") for o in "123"] if table == "estabelecimento" else [(root,)]:
                    if rng.random() < share:
                        kind = rng.choice(["INSERT", "UPDATE", "DELETE"] if table != "empresa" else ["INSERT", "UPDATE", "UPDATE", "DELETE"])
                        value = {"estabelecimento": {"situacao_cadastral": rng.randint(1, 8), "municipio": 1}, "empresa": {"capital_social": float(rng.randint(1, 99))}, "simples": {"opcao_mei": rng.choice("SN")}, "socios": dict.fromkeys(PARTNER_ZERO, rng.randint(1, 9))}[table]
                        rows.append((key, kind, None if kind == "DELETE" else value))
            own = events(spark, table, rows, month)
            made = own if made is None else made.unionByName(own)
        ledger[table] = made
    base = [est(r, o, rng.randint(1, 8)) for r in roots for o in "123" if rng.random() < 0.5]
    got, _ = run(spark, base, ledger, [company(r, 1.0) for r in roots if rng.random() < 0.8], fiscal=[(r, "S", 1, 2, "N", 3, 4) for r in roots[::3]], end="2023-09")
    assert {k[0] for k in got} == {"2023-05", *months} and len(got) > 300


def test_the_plan_of_intervals_does_not_grow_with_the_months(spark):
    sizes = []
    for end in ("2023-07", "2024-07"):
        months = E.month_range("2023-05", end)
        latest = spark.createDataFrame([(1, 20200101, 1)], "k int, data_inicio_atividade int, x int")
        spec = TableSpec("t", ["k"], ["data_inicio_atividade", "x"])
        none = latest.where("false").withColumn("is_deleted", F.lit(False))
        plan = timeline.panel_by_reverse_intervals(latest, cdc.detect(latest, none, latest, spec, "2023-06"), ["k"], months)._jdf.queryExecution().executedPlan().toString()
        sizes.append((plan.count("Join"), plan.count("Exchange")))
    assert sizes[0] == sizes[1]


def test_start_after_end(spark):
    with pytest.raises(ValueError, match="no months"):
        E.month_range("2023-07", "2023-05")
    assert E.month_range("2022-11", "2023-02") == ["2022-11", "2022-12", "2023-01", "2023-02"]


def test_reverse_undoes_forward(spark):
    spec, schema = TableSpec("t", ["k"], ["data_inicio_atividade", "x"]), "k int, data_inicio_atividade int, x int"
    months = {"2023-05": [(1, 20200101, 1), (2, 20200101, 1), (5, None, 5)], "2023-06": [(1, 20200101, 2), (3, 20230610, 1), (5, None, 5)], "2023-07": [(1, 20200101, 2), (2, 20200101, 4), (3, 20230610, None), (5, None, 5)]}
    dumps = {m: spark.createDataFrame(r, schema) for m, r in months.items()}
    none = dumps["2023-05"].where("false").withColumn("is_deleted", F.lit(False))
    a, b, c = dumps.values()
    ledger = cdc.detect(b, none, a, spec, "2023-06").unionByName(cdc.detect(c, none, b, spec, "2023-07"))
    panel = reverse.panel_from_reverse(c, ledger, ["k"], list(months))
    at_once = timeline.panel_by_reverse_intervals(c, ledger, ["k"], list(months))
    assert sorted(map(repr, at_once.select(*panel.columns).collect())) == sorted(map(repr, panel.collect()))
    assert sorted(tuple(r) for r in panel.select("reference_month", "k", "x").fillna(-1).collect()) == sorted((m, k, -1 if x is None else x) for m, rows in months.items() for k, _, x in rows)
    assert reverse.save_month(b, "2023-05").count() == 2  # opened later: not yet


def panel(spark, rows):
    return spark.createDataFrame(rows, "reference_month string, k int, a string, b string")


def test_intervals(spark):
    p = panel(spark, [("2023-01", 1, "x", "p"), ("2023-02", 1, "x", "q"), ("2023-03", 1, "x", "p"), ("2023-04", 1, "y", "p"), ("2023-01", 2, None, "p"), ("2023-03", 2, None, "p")])
    got = lambda **o: sorted(tuple(r) for r in temporal.intervals(p, ["k"], ["a"], ["b"], **o).fillna("-").collect())
    assert got() == [(1, "x", "p", "2023-01", "2023-03"), (1, "x", "q", "2023-02", "2023-02"), (1, "y", "p", "2023-04", "2023-04"), (2, "-", "p", "2023-01", "2023-03")]
    assert (2, "-", "p", "2023-01", "2023-01") in got(strict=True)


@pytest.mark.parametrize("strict", [False, True])
def test_intervals_month_by_month_are_the_full_build(spark, tmp_path, strict):
    rng = random.Random(3)
    months = E.month_range("2022-11", "2023-04")
    rows = [(m, k, rng.choice(["x", "y", None]), rng.choice(["p", "q"])) for m in months for k in range(60) if rng.random() < 0.75]
    made = Periods(spark, str(tmp_path), ["k"], ["a"], ["b"], strict)
    for n, m in enumerate(months, 1):
        assert made.add(panel(spark, rows).where(F.col("reference_month") == m).drop("reference_month"), m)
        full = temporal.intervals(panel(spark, [r for r in rows if r[0] <= m]), ["k"], ["a"], ["b"], strict=strict)
        if n % 3 == 0:
            assert sorted(map(repr, made.read().select(full.columns).collect())) == sorted(map(repr, full.collect()))
    assert not made.add(panel(spark, rows).drop("reference_month"), months[-1])
    with pytest.raises(ValueError, match="older"):
        made.add(panel(spark, rows).drop("reference_month"), "2020-01")
    before = sorted(map(repr, made.read().collect()))
    assert len(made.vacuum()) == len(months) - 1 and made.vacuum() == [] and before == sorted(map(repr, made.read().collect()))


def test_a_hash_tree_opens_what_differs(spark, tmp_path):
    a = spark.range(20_000).select(F.col("id").alias("k"), F.when(F.col("id") % 7 > 0, F.col("id") % 10).alias("x"), F.lit("v").alias("y"))
    changed = F.when(F.col("k").isin(3, 78), None).when(F.col("k") == 5_000, -1).otherwise(F.col("x"))
    b = a.where("k <> 9").withColumn("x", changed).union(spark.createDataFrame([(-5, 1, "new")], a.schema))
    t, same, u = (tree.HashTree.write(rows.repartition(n), f"{tmp_path}/{n}", ["k"], ["x", "y"]) for n, rows in ((1, a), (7, a), (3, b)))
    assert t.root() == same.root() != u.root() and tree.unequal_leaves(t, same) == []
    assert [x.count() for x in tree.opened(t, same)] == [0, 0]
    x, y = tree.opened(t, u)
    gate = lambda c, d: sorted(map(repr, checks.regression_gate(c, d, ["k"], ["x"], ["y"], a.where("false"), "k").collect()))
    assert gate(x, y) == gate(a, b) and len(gate(x, y)) == 5
    assert x.count() < 80 and "PartitionFilters: [branch" in x._jdf.queryExecution().executedPlan().toString().replace("isnotnull(branch#", "branch")
    swapped = a.select("k", F.col("x").cast("string").alias("y"), F.lit(None).cast("long").alias("x"))
    assert tree.HashTree.write(swapped, f"{tmp_path}/s", ["k"], ["x", "y"]).root() != t.root()


def test_transitions_and_classes(spark):
    p = panel(spark, [("2023-01", 1, "x", "p"), ("2023-02", 1, "x", None), ("2023-02", 2, "y", "p")])
    got = sorted((r["k"], r["reference_month"], r["variable_name"], r["previous_value"] or "", r["current_value"] or "", r["change_type"]) for r in temporal.transitions(p, ["k"], ["a", "b"], ["2023-01", "2023-02", "2023-03"]).collect())
    assert got == [(1, "2023-02", "b", "p", "", "UPDATE"), (1, "2023-03", "a", "x", "", "DELETE"), (1, "2023-03", "b", "", "", "DELETE"), (2, "2023-02", "a", "", "y", "INSERT"), (2, "2023-02", "b", "", "p", "INSERT"), (2, "2023-03", "a", "y", "", "DELETE"), (2, "2023-03", "b", "p", "", "DELETE")]
    one, two = (p.where(F.col("reference_month") == m) for m in ("2023-01", "2023-02"))
    row = temporal.reconcile(temporal.classify(one, two, ["k"], ["a", "b"])).first()
    assert (row["inserted"], row["updated"], row["next_holds"], row["previous_holds"]) == (1, 1, True, True)
    assert temporal.transitions(p, ["k"], ["a"], ["2023-01"]).isEmpty()


def test_gate(spark):
    a, b = (spark.createDataFrame(r, "k int, s string, v string") for r in ([(1, " sp", "1"), (2, "0", "2")], [(1, "SP ", None), (2, "0.0", "2")]))
    held = spark.createDataFrame([(1,)], "k int")
    assert [r["verdict"] for r in checks.regression_gate(a, b, ["k"], ["s"], ["v"], held, "k").collect()] == ["allowed"]
    assert checks.gate_passes(checks.regression_gate(a, b, ["k"], ["s"], ["v"], held, "k")) and not checks.gate_passes(checks.regression_gate(a, b, ["k"], ["s"], ["v"], held.where("false"), "k"))


def test_keyed_changes_and_json(spark):
    rows, new = (spark.createDataFrame(r, "k int, v string") for r in ([(1, "a"), (2, "b")], [(2, None), (3, "c")]))
    got = lambda f: sorted(((r["k"], r["v"] or "") for r in f.collect()))
    assert got(keyed.upsert(rows, new, ["k"])) == [(1, "a"), (2, ""), (3, "c")]
    assert got(keyed.insert_ignore(rows, new, ["k"])) == [(1, "a"), (2, "b"), (3, "c")]
    assert got(keyed.update_from(rows, new, ["k"], ["v"])) == [(1, "a"), (2, "")]
    assert got(keyed.overlay(new, rows, ["k"])) == [(1, "a"), (2, ""), (3, "c")]
    assert rows.select(E.json_without(E.json_image("k", "v"), "k").alias("j")).first()["j"] == '{"v":"a"}'


def test_a_month_save_looks_roots_up_without_sorting_partners(spark):
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        partners = spark.createDataFrame([("1", 2, "a", None, 5, 20200101, None, None, None, None, 4), ("3", 2, "b", None, 5, 20200101, None, None, None, None, 4)], SOCIOS)
        none = spark.createDataFrame([], "mes_referencia string, cnpj_basico string, partner_additions int, partner_removals int, qualification_changes int")
        saved = reverse.save_registry(spark.createDataFrame([est("1", "1"), est("3", "1", uf="RJ")], EST), spark.createDataFrame([company("1", 10.0), company("3", 1.0)], EMPRESA), spark.createDataFrame([], SIMPLES), partners, none, "2023-05", "SP")
        for name in ("companies", "fiscal", "partners"):
            plan = saved[name]._jdf.queryExecution().executedPlan().toString()
            assert "ShuffledHashJoin" in plan and "Sort" not in plan.replace("SortAggregate", "")
        assert [r["cnpj_basico"] for r in saved["partners"].collect()] == ["1"] == [r["cnpj_basico"] for r in saved["summaries"].collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
