"""Change detection: the golden months, and properties of detect and apply."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelforge.operators import cdc, dedup
from panelforge.operators.summary import partner_summary
from panelforge.schemas import EMPRESA, ESTABELECIMENTO, ESTABLISHMENT_KEY, SIMPLES, SOCIOS, SPECS, TableSpec
from panelforge.sinks import files
from panelforge.sinks.files import land_month, mark_complete
from panelforge.sources import files as sources
from panelforge.streaming import files as stream_files
from panelforge.streaming import monthly
from panelforge.streaming.files import FileLedger
from panelforge.streaming.monthly import MonthlyChanges, empty_overlay

BASE = [("12345678", "Empresa Teste A", 1015, 2, 5000.0, 1, "ENTE A"), ("87654321", "Empresa Teste B", 2062, 3, 10000.0, 3, None)]
JUNE = [
    ("11112222", "Empresa Inserida", 2062, 3, 20000.0, 3, "ENTE NEW"), ("12345678", "Empresa Teste A", 1015, 2, 7500.0, 1, "ENTE A"), ("87654321", "Empresa Teste B", 2062, 3, 10000.0, 3, None),
    ("99999999", "Dup 1", 1015, None, 100.0, None, None), ("99999999", "Dup 2", 1015, 2, 100.0, 1, "ENTE X"), ("88888888", "Tie B", 1015, 2, 100.0, None, None), ("88888888", "Tie A", 1015, 2, 100.0, None, None),
]
JULY = [
    ("12345678", "Empresa Teste A", 1015, 2, 9000.0, 1, "ENTE A"), ("87654321", "Other name", 2062, 3, 15000.0, 3, None),
    ("99999999", "Dup renamed", 1015, 2, 100.0, 1, "ENTE X"), ("88888888", "Tie B", 1015, None, 100.0, None, None),
]


def kinds(events, *fields):
    return sorted((r[0], r["tipo_alteracao"], *[r["novo"][f] if r["novo"] else None for f in fields]) for r in events.collect())


def company_months(spark):
    spec = SPECS["empresa"]
    base, june, july = (spark.createDataFrame(x, EMPRESA) for x in (BASE, JUNE, JULY))
    latest = empty_overlay(spark, EMPRESA, spec)
    first = cdc.detect(dedup.resolve_companies(june), latest, base, spec, "2023-06")
    after = cdc.apply_events(latest, first, spec)
    second = cdc.detect(dedup.resolve_companies(july), after, base, spec, "2023-07")
    return first, after, second


def test_two_months_of_companies(spark):
    first, after, second = company_months(spark)
    assert kinds(first, "capital_social") == [("11112222", "INSERT", 20000.0), ("12345678", "UPDATE", 7500.0), ("88888888", "INSERT", 100.0), ("99999999", "INSERT", 100.0)]
    assert after.where("cnpj_basico = '99999999'").first()["porte_empresa"] == 1
    assert kinds(second, "capital_social", "qualificacao_responsavel") == [("11112222", "DELETE", None, None), ("12345678", "UPDATE", 9000.0, 2), ("87654321", "UPDATE", 15000.0, 3), ("88888888", "UPDATE", 100.0, None)]
    assert kinds(company_months(spark)[2]) == kinds(second)  # a replay gives the same events


def test_tombstone_then_insert_again(spark):
    spec = SPECS["empresa"]
    _, after, second = company_months(spark)
    gone = cdc.apply_events(after, second, spec)
    row = gone.where("cnpj_basico = '11112222'").first()
    assert row["is_deleted"] and row["capital_social"] == 20000.0
    back = dedup.resolve_companies(spark.createDataFrame(JUNE[:1], EMPRESA))
    event = cdc.detect(back, gone, spark.createDataFrame(BASE, EMPRESA), spec, "2023-08").where("cnpj_basico = '11112222'").first()
    assert event["tipo_alteracao"] == "INSERT" and event["anterior"]["capital_social"] == 20000.0


def test_establishment_update_ignores_untracked_columns(spark):
    def est(ordem, **x):
        return [x.get(f.name, {"cnpj_basico": ordem[0], "cnpj_ordem": ordem[1], "cnpj_dv": ordem[2]}.get(f.name)) for f in ESTABELECIMENTO]

    a, b = ("12345678", "0001", "99"), ("87654321", "0002", "88")
    base = spark.createDataFrame([est(a, nome_fantasia="A", situacao_cadastral=2, uf="SP"), est(b, nome_fantasia="B", situacao_cadastral=2, uf="RJ")], ESTABELECIMENTO)
    june = spark.createDataFrame([est(a, nome_fantasia="A changed", situacao_cadastral=8, uf="SP"), est(b, nome_fantasia="B changed", ddd_1="99", situacao_cadastral=2, uf="RJ")], ESTABELECIMENTO)
    spec = SPECS["estabelecimento"]
    events = cdc.detect(june, empty_overlay(spark, ESTABELECIMENTO, spec), base, spec, "2023-06")
    assert [(r["cnpj_basico"], r["tipo_alteracao"], r["novo"]["situacao_cadastral"]) for r in events.collect()] == [("12345678", "UPDATE", 8)]
    assert "nome_fantasia" not in events.schema["novo"].dataType.names


def test_partner_summary_and_default_tombstone(spark):
    rows = [("1", 2, "a", None, 5, 0, None, None, None, None, 0), ("1", 1, "b", None, 49, 20200101, None, None, None, None, 4), ("1", 3, "c", None, 7, 20190101, None, None, None, None, 2)]
    old = partner_summary(spark.createDataFrame(rows, SOCIOS))
    assert old.first()[1:] == (3, 1, 1, 1, 2, 4, 20190101, 20200101, 2)
    spec = SPECS["socios"]
    none = old.where("false").withColumns({"is_deleted": F.lit(False), "last_updated_month": F.lit("")})
    gone = cdc.apply_events(none, cdc.detect(old.where("false"), none, old, spec, "2023-06"), spec).first()
    assert gone["is_deleted"] and gone["qtde_socios"] == 0 and gone["min_faixa_etaria"] is None


def test_quarantine_and_fiscal_rank(spark):
    rows = spark.createDataFrame([("1", "a", 1, 2, 1.0, None, None), ("1", "b", 1, 3, 2.0, 5, None), ("2", "a", 1, None, 1.0, None, "x"), ("2", "b", None, 3, 1.0, 5, None)], EMPRESA)
    held = dedup.quarantine(rows, "2023-06").collect()
    assert [tuple(r) for r in held] == [("1", "Conflict in staging company fields: capital_social (2) qualificacao_responsavel (2) ", "2023-06")]
    done = {r["cnpj_basico"]: r for r in dedup.resolve_companies(rows).collect()}
    assert done["1"]["razao_social"] == "b" and done["1"]["capital_social"] is None and done["1"]["natureza_juridica"] is None
    assert (done["2"]["natureza_juridica"], done["2"]["qualificacao_responsavel"], done["2"]["porte_empresa"]) == (1, 3, 5)
    fiscal = spark.createDataFrame([("1", "S", 0, None, None, 0, None), ("1", "N", 20200101, None, None, 0, None), ("1", None, None, None, "S", 20200101, None)], SIMPLES)
    assert dedup.dedup_fiscal(fiscal).first()["opcao_pelo_simples"] == "N"


VALUES = st.dictionaries(st.integers(0, 6), st.tuples(st.sampled_from([None, 1, 2]), st.sampled_from([None, "a"])), max_size=6)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(VALUES, VALUES, VALUES)
def test_overlay_over_baseline_is_the_last_dump(spark, a, b, c):
    spec, schema = TableSpec("t", ["k"], ["x", "y"]), "k int, x int, y string"
    frames = [spark.createDataFrame([(k, *v) for k, v in d.items()], schema) for d in (a, b, c)]
    latest = empty_overlay(spark, frames[0].schema, spec)
    for n, dump in enumerate(frames[1:]):
        latest = spark.createDataFrame(cdc.apply_events(latest, cdc.detect(dump, latest, frames[0], spec, f"2023-0{n + 6}"), spec).collect(), latest.schema)
    state = cdc.known_state(latest, frames[0], spec).where("NOT is_deleted").select("k", "x", "y")
    assert sorted(map(tuple, state.collect()), key=repr) == sorted(map(tuple, frames[2].collect()), key=repr)


def statuses(job):
    return sorted((r["month"], r["status"], r["inserts"], r["updates"], r["deletes"]) for r in job.runs.read().collect())


def test_stream_runs_each_month_once_and_notes_failures(spark, tmp_path):
    spec, base, landing = SPECS["empresa"], spark.createDataFrame(BASE, EMPRESA), f"{tmp_path}/landing"
    for month, rows in (("2023-06", JUNE), ("2023-07", JULY)):
        land_month(spark.createDataFrame(rows, EMPRESA), landing, month)
    job = MonthlyChanges(spark, f"{tmp_path}/job", spec, base, dedup.resolve_companies)
    job.follow(landing)
    job.follow(landing)
    assert statuses(job) == [("2023-06", "SUCCESS", 3, 1, 0), ("2023-07", "SUCCESS", 0, 3, 1)]
    assert list(job.runs.folders()) == ["2023-06", "2023-07"] and job.ledger().count() == 8
    with pytest.raises(ValueError, match="no rows"):
        job.run(base.where("false"), "2023-08")
    assert list(job.runs.folders()) == ["2023-06", "2023-07"] and not job.done("2023-08")
    with pytest.raises(ValueError, match="older"):
        job.run(base, "2023-04")


def test_partial_landings_wait_or_fail(spark, tmp_path):
    spec, base, landing = SPECS["empresa"], spark.createDataFrame(BASE, EMPRESA), f"{tmp_path}/landing"
    june, folder = spark.createDataFrame(JUNE, EMPRESA), f"{landing}/data/2023-06/by-hand"
    june.where("cnpj_basico < '5'").write.parquet(folder)
    job = MonthlyChanges(spark, f"{tmp_path}/job", spec, base, dedup.resolve_companies)
    mark_complete(spark, landing, "2023-06", len(JUNE), folder)
    assert job.follow(landing) == ["2023-06"]  # the marker is there, some files are not
    assert statuses(job) == [("2023-06", "FAILED", 0, 0, 0)]
    june.where("cnpj_basico > '5'").write.mode("append").parquet(folder)
    assert job.follow(landing) == []
    assert statuses(job) == [("2023-06", "SUCCESS", 3, 1, 0)]
    spark.createDataFrame(JULY, EMPRESA).write.parquet(f"{landing}/data/2023-07/by-hand")
    job.follow(landing)  # no marker: July waits
    assert not job.done("2023-07")


def test_landings_are_repeatable_and_markers_correctable(spark, tmp_path, monkeypatch):
    spec, base, landing = SPECS["empresa"], spark.createDataFrame(BASE, EMPRESA), f"{tmp_path}/landing"
    june, july = spark.createDataFrame(JUNE, EMPRESA), spark.createDataFrame(JULY, EMPRESA)
    job = MonthlyChanges(spark, f"{tmp_path}/job", spec, base, dedup.resolve_companies)
    with monkeypatch.context() as m:  # dies after its rows are written
        m.setattr(files, "mark_complete", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            land_month(june, landing, "2023-06")
    assert land_month(june.where("cnpj_basico < '5'"), landing, "2023-06") != land_month(june, landing, "2023-06")
    mark_complete(spark, landing, "2023-07", 1, f"{landing}/nowhere")  # a wrong marker
    assert job.follow(landing) == ["2023-07"] and job.follow(landing) == ["2023-07"]
    assert statuses(job) == [("2023-06", "SUCCESS", 3, 1, 0), ("2023-07", "FAILED", 0, 0, 0)]
    land_month(july, landing, "2023-07")
    assert job.follow(landing) == [] and job.follow(landing) == []
    assert statuses(job)[1] == ("2023-07", "SUCCESS", 0, 3, 1)
    assert [r["status"] for r in job.runs.attempts().where("month = '2023-07'").orderBy("attempt").collect()] == ["FAILED", "FAILED", "SUCCESS"]


def test_vacuum_removes_what_no_reader_needs(spark, tmp_path, monkeypatch):
    base = spark.createDataFrame(BASE, EMPRESA)
    job = MonthlyChanges(spark, f"{tmp_path}/job", SPECS["empresa"], base, dedup.resolve_companies)
    with monkeypatch.context() as m:
        m.setattr(monthly, "apply_events", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            job.run(spark.createDataFrame(JUNE, EMPRESA), "2023-06")
    job.run(spark.createDataFrame(JUNE, EMPRESA), "2023-06")
    job.run(spark.createDataFrame(JULY, EMPRESA), "2023-07")
    before = [sorted(map(repr, x.collect())) for x in (job.ledger(), job.overlay())]
    gone = job.vacuum(keep=1)
    assert len(gone) == 2 and sum(x.endswith("/overlay") for x in gone) == 1 and job.vacuum(keep=1) == []
    assert before == [sorted(map(repr, x.collect())) for x in (job.ledger(), job.overlay())]


def test_files_are_read_once(spark, tmp_path, monkeypatch):
    landing, ledger = tmp_path / "in", FileLedger(spark, f"{tmp_path}/ledger")
    (landing / "2023-06").mkdir(parents=True)
    (landing / "K.csv").write_text("1;a\n2;b\n")
    (landing / "2023-06" / "K.csv").write_text("3;c\n")
    schema = T.StructType().add("k", "long").add("v", "string")

    def read(paths):
        return sources.read_dump(spark, paths, schema, file=True)

    def rows():
        return sorted((r["file"], r["k"], r["v"]) for r in ledger.rows().collect())

    with monkeypatch.context() as m:  # dies after its rows are written
        m.setattr(stream_files, "append_row", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            ledger.take(str(landing), read)
    assert ledger.new(str(landing)).count() == 2
    assert ledger.take(f"file://{landing}/", read) == 2 and ledger.take(str(landing), read) == 0
    assert rows() == [("2023-06/K.csv", 3, "c"), ("K.csv", 1, "a"), ("K.csv", 2, "b")]
    (landing / "K.csv").write_text("1;a\n2;B\n5;e\n")  # corrected
    (landing / "L.csv").write_text("9;z\n")
    assert ledger.take(str(landing), read) == 2
    assert rows() == [("2023-06/K.csv", 3, "c"), ("K.csv", 1, "a"), ("K.csv", 2, "B"), ("K.csv", 5, "e"), ("L.csv", 9, "z")]
    assert len(ledger.vacuum()) == 1 and ledger.vacuum() == [] and len(rows()) == 5


@pytest.mark.parametrize("broken", ["ledger", "overlay", "count", "note"])
def test_a_rerun_after_a_crash_is_an_undisturbed_run(spark, tmp_path, monkeypatch, broken):
    base = spark.createDataFrame(BASE, EMPRESA)
    jobs = [MonthlyChanges(spark, f"{tmp_path}/{k}", SPECS["empresa"], base, dedup.resolve_companies) for k in "ab"]
    june, july = spark.createDataFrame(JUNE, EMPRESA), spark.createDataFrame(JULY, EMPRESA)

    def crash(*_, **__):
        raise RuntimeError("lost")

    for job in jobs:
        job.run(june, "2023-06")
    with monkeypatch.context() as m:
        # each of these comes after one more write of the month is done
        m.setattr(*{"ledger": (monthly, "detect", crash), "overlay": (monthly, "apply_events", crash), "count": (monthly, "count_events", crash), "note": (monthly.Runs, "note", crash)}[broken])
        with pytest.raises(RuntimeError, match="lost"):
            jobs[0].run(july, "2023-07")
    for job in jobs:
        assert job.run(july, "2023-07")
    a, b = (([sorted(map(repr, x.collect())) for x in (job.ledger(), job.overlay())], statuses(job)) for job in jobs)
    assert a == b and b[1][1] == ("2023-07", "SUCCESS", 0, 3, 1)


def test_older_rules_miss_a_return_to_the_baseline(spark):
    spec, schema = TableSpec("t", ["k"], ["x"]), "k int, x int"
    base, ledger = spark.createDataFrame([(1, 1), (2, 1)], schema), spark.createDataFrame([(1, 2), (3, 5)], schema).select("k", F.struct("x").alias("novo"), F.lit(1).alias("id"))
    dump = spark.createDataFrame([(1, 1), (2, 3), (3, 6), (4, 0)], schema)
    assert kinds(cdc.detect_against_ledger(dump, base, ledger, spec, "2023-07")) == [(2, "UPDATE"), (3, "INSERT"), (4, "INSERT")]


def test_json_boundary_keeps_nulls(spark):
    first, _, _ = company_months(spark)
    ledger = cdc.as_json(first, SPECS["empresa"])
    assert '"ente_federativo_responsavel":null' in ledger.where("cnpj_basico = '88888888'").first()["conteudo_novo"]
    back = cdc.from_json(ledger, first.schema["novo"].dataType.simpleString()[7:-1].replace(":", " "))
    assert kinds(back.drop("tabela"), "capital_social") == kinds(first, "capital_social")
    assert ESTABLISHMENT_KEY[0] in ledger.columns
