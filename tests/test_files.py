"""Readers and writers."""

import zipfile

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from panelforge import cli
from panelforge.schemas import EMPRESA, ESTABELECIMENTO, MUNIC, SIMPLES, SOCIOS, SPECS
from panelforge.sinks import files as sinks
from panelforge.sources import files as sources
from panelforge.streaming.monthly import RegistryMonths
from panelforge.streaming.snapshots import SnapshotMonths

LINES = [
    '"00000001";"Água ""X""";"0101";"05";"1234,50";"01";""', '"00000002";NA;2062;3;"10,0"', '"00000003";"a;b";1;1;"1,0";1;x', '"00000004";"too";1;1;"1,0";1;"many";"fields"', '"00000005";"n";00;;;;NULL',
]


def test_dump(spark, tmp_path):
    (tmp_path / "K1.EMPRECSV").write_bytes("\n".join(LINES).encode("latin-1"))
    rows = {r["cnpj_basico"]: r for r in sources.read_registry(spark, str(tmp_path))["empresa"].collect()}
    assert rows.keys() == {"00000001", "00000002", "00000003", "00000005"}
    assert tuple(rows["00000001"]) == ("00000001", 'Água "X"', 101, 5, 1234.5, 1, None)
    assert tuple(rows["00000002"]) == ("00000002", None, 2062, 3, 10.0, None, None)
    assert rows["00000003"]["razao_social"] == "a;b" and rows["00000005"]["natureza_juridica"] == 0


def test_multiline_and_zip(spark, tmp_path):
    (tmp_path / "m.csv").write_bytes('"1";"two\nlines";1;1;"1,0";1;x\n'.encode())
    assert sources.read_dump(spark, f"{tmp_path}/m.csv", EMPRESA, multiline=True).first()["razao_social"] == "two\nlines"
    with zipfile.ZipFile(tmp_path / "e.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("K1.EMPRECSV", "\n".join(LINES).encode("latin-1"))
    assert sorted(map(repr, sources.read_zipped(spark, f"{tmp_path}/e.zip", EMPRESA).collect())) == sorted(map(repr, _plain(spark, tmp_path)))
    data = bytearray((tmp_path / "e.zip").read_bytes())
    data[60] ^= 255
    (tmp_path / "bad.zip").write_bytes(data)
    with pytest.raises(Exception, match="(?i)zip|crc|decompress|invalid"):
        sources.read_zipped(spark, f"{tmp_path}/bad.zip", EMPRESA).count()


def _plain(spark, tmp_path):
    (tmp_path / "p.csv").write_bytes("\n".join(LINES).encode("latin-1"))
    return sources.read_dump(spark, f"{tmp_path}/p.csv", EMPRESA).collect()


def test_landing_folder_with_zips_and_nested_folders(spark, tmp_path):
    (tmp_path / "in/deep").mkdir(parents=True)
    with zipfile.ZipFile(tmp_path / "in/Empresas0.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("K1.EMPRECSV", "\n".join(LINES[:2]).encode("latin-1"))
        z.writestr("docs/readme.txt", "nothing of ours")
    with zipfile.ZipFile(tmp_path / "in/deep/mixed.zip", "w") as z:
        z.writestr("K1.CNAECSV", '"0111301";"Rice"\n')
        z.writestr("x/K2.EMPRECSV", LINES[4])
    (tmp_path / "in/deep/K3.EMPRECSV").write_bytes("\n".join(LINES[2:4]).encode("latin-1"))
    found = sources.read_registry(spark, f"{tmp_path}/in")
    assert found.keys() == {"empresa", "cnae"}
    assert sorted(r["cnpj_basico"] for r in found["empresa"].collect()) == ["00000001", "00000002", "00000003", "00000005"]
    assert tuple(found["cnae"].first()) == ("0111301", "Rice")


def test_only_the_files_of_a_month_are_read(spark, tmp_path):
    for folder, line in (("2023-05", LINES[0]), ("2023-06/deep", LINES[1]), ("any", LINES[4])):
        (tmp_path / folder).mkdir(parents=True)
        (tmp_path / folder / "K1.EMPRECSV").write_bytes(line.encode("latin-1"))
    found = {m: sorted(r[0] for r in sources.read_registry(spark, str(tmp_path), m)["empresa"].collect()) for m in ("2023-05", "2023-06", None)}
    assert found == {"2023-05": ["00000001", "00000005"], "2023-06": ["00000002", "00000005"], None: ["00000001", "00000002", "00000005"]}


def test_zips_of_a_file_system_that_only_spark_reads(spark, tmp_path):
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.store.link./in", f"file://{tmp_path}")
    with zipfile.ZipFile(tmp_path / "Empresas0.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("K1.EMPRECSV", "\n".join(LINES).encode("latin-1"))
        z.writestr("docs/readme.txt", "nothing of ours")
    with zipfile.ZipFile(tmp_path / "Cnaes.zip", "w") as z:
        z.writestr("unnamed", '"0111301";"Rice"\n')
    there, here = (sources.read_registry(spark, p) for p in ("viewfs://store/in", str(tmp_path)))
    assert there.keys() == here.keys() == {"empresa", "cnae"}
    for family in there:
        assert sorted(map(repr, there[family].collect())) == sorted(map(repr, here[family].collect())) and there[family].count() in (1, 4)


def test_a_month_of_the_registry_from_the_command_line(spark, tmp_path, capsys):
    est = spark.createDataFrame([["1", "0001", "00", 1, None, 2, *[None] * 24]], ESTABELECIMENTO)
    base = {"empresa": spark.createDataFrame([("1", "n", 1, 1, 1.0, 1, None), ("2", "n", 1, 1, 1.0, 1, None)], EMPRESA), "estabelecimento": est}
    base |= {"socios": spark.createDataFrame([("1", 2, "p", None, 5, 20200101, None, None, None, None, 3)], SOCIOS), "simples": spark.createDataFrame([("1", "S", 0, 0, "N", 0, 0)], SIMPLES)}
    for name, rows in base.items():
        rows.write.parquet(f"{tmp_path}/base/{name}")
    (tmp_path / "in").mkdir()
    (tmp_path / "in/K.EMPRECSV").write_text('"1";"n";1;1;"2,0";1;\n"3";"n";1;1;"2,0";1;\n"3";"m";1;1;"9,0";1;\n')
    (tmp_path / "in/K.ESTABELE").write_text(";".join(["1", "0001", "00", "1", "", "8", *[""] * 24]) + "\n")
    (tmp_path / "in/K.SOCIOCSV").write_text("1;2;p;;5;20200101;;;;;3\n1;2;q;;5;20200101;;;;;3\n")
    command = ["month", f"{tmp_path}/base", f"{tmp_path}/in", f"{tmp_path}/root", "2023-06"]
    with pytest.raises(KeyError):
        cli.main(command)  # a table has not landed
    (tmp_path / "in/F.SIMPLES").write_text("1;S;0;0;N;0;0\n")
    cli.main(command)
    cli.main(command)
    assert capsys.readouterr().out.splitlines() == ["2023-06: 1 inserted, 3 updated, 1 deleted", "2023-06: 1 inserted, 3 updated, 1 deleted (done before)"]
    job = RegistryMonths(spark, f"{tmp_path}/root", base)
    assert [(r["month"], r["tabela"], r["status"], r["inserts"]) for r in job.runs.read().collect()] == [("2023-06", "*", "SUCCESS", 1)]
    assert [tuple(r) for r in job.held.read().collect()] == [("3", "Conflict in staging company fields: capital_social (2) ", "2023-06")]
    assert spark.read.parquet(f"{tmp_path}/root/ignored/empresa").count() == 3
    command[3:4] = [f"{tmp_path}/snapshots"]
    for _ in range(2):
        cli.main([*command, "--buckets", "3"])
    assert capsys.readouterr().out.splitlines() == ["2023-06: 1 inserted, 3 updated, 1 deleted", "2023-06: 1 inserted, 3 updated, 1 deleted (done before)"]
    kept = SnapshotMonths(spark, f"{tmp_path}/snapshots", SPECS, {})
    assert [tuple(r) for r in kept.extra("quarantine").collect()] == [("3", "Conflict in staging company fields: capital_social (2) ", "2023-06")] and kept.extra("empresa").count() == 3
    for table in SPECS:
        assert sorted(map(repr, kept.overlay(table).collect())) == sorted(map(repr, job.tables[table].overlay().collect()))
    cli.main(["export", f"{tmp_path}/root/ignored/empresa", f"{tmp_path}/csv", "--order", "cnpj_basico,razao_social", "--limit", "2"])
    assert [tuple(r)[:2] for r in spark.read.csv(f"{tmp_path}/csv", header=True).collect()] == [("1", "n"), ("3", "m")]


def test_tail_and_skipped(spark, tmp_path):
    (tmp_path / "t.csv").write_text("".join(f'"{k}";x\n' for k in range(50)))
    assert sorted((r["line"], r["value"]) for r in sources.read_tail(spark, f"{tmp_path}/t.csv", 47).collect()) == [(47, "47"), (48, "48"), (49, "49")]
    (tmp_path / "two").mkdir()
    for name, n in (("a", 30_000), ("b", 10_000)):
        (tmp_path / "two" / name).write_text("".join(f"{name}{k}\n" for k in range(n)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:  # many splits of both files, packed together as Spark likes
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
        got = sorted((r["line"], r["value"]) for r in sources.read_tail(spark, f"{tmp_path}/two", 9_999).collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == sorted([(9_999, "b9999"), *((k, f"a{k}") for k in range(9_999, 30_000))])
    (tmp_path / "g.csv").write_text("cnpj_basico,tipo_logradouro,logradouro,numero,uf,cidade,bairro,cep,latitude,longitude\n1,R,l,1,SP,x,b,1,abc,1\n1,R,too,few\n1,R,l,1,SP,x,b,1,2,1\n")
    assert tuple(sources.count_places(spark, f"{tmp_path}/g.csv").first()) == (1, 2)
    assert sources.read_places(spark, f"{tmp_path}/g.csv").select("latitude").count() == sources.read_places(spark, f"{tmp_path}/g.csv").count() == 1


def test_routes():
    assert [sources.route(n) for n in ("k.estabele", "X.SOCIOCSV", "F.SIMPLES.CSV", "CNAECSV", "other")] == ["estabelecimento", "socios", "simples", "cnae", None]
    assert sources.route("empre", any_case=False) is None


def test_lookup_and_places(spark, tmp_path):
    (tmp_path / "munic.csv").write_text("codigo , descricao,cd_mun\n7107,SAO PAULO,3550308\n")
    assert tuple(sources.read_lookup(spark, f"{tmp_path}/munic.csv", MUNIC).first()) == (7107, "SAO PAULO", 3550308)
    head = "cnpj_basico,tipo_logradouro,logradouro,numero,uf,cidade,bairro,cep,latitude,longitude\n"
    (tmp_path / "g.csv").write_text(head + "123,RUA,a\tb,nan,SP,x, ,12345.0,-23.5,-46.6\n123456789,R,l,1,SP,x,b,,,\n1,R,l,1,SP,x,b,1,abc,1\n1,R,too,few\n")
    rows = sorted(map(tuple, sources.read_places(spark, f"{tmp_path}/g.csv").collect()))
    assert rows == [("00000123", "RUA", "a b", None, "SP", "x", None, "00012345", -23.5, -46.6), ("123456789", "R", "l", "1", "SP", "x", "b", "00000000", None, None)]


def test_panel_months_replace_themselves(spark, tmp_path):
    rows = spark.createDataFrame([("2023-05", "2", "1", "0", 1), ("2023-05", "1", "1", "0", 1), ("2023-06", "1", "1", "0", 1)], "reference_month string, cnpj_basico string, cnpj_ordem string, cnpj_dv string, v int")
    sinks.write_panel(rows, f"{tmp_path}/p")
    sinks.write_panel(rows.where("reference_month = '2023-06'").withColumn("v", F.lit(2)), f"{tmp_path}/p")
    assert sorted((r["reference_month"], r["v"]) for r in spark.read.parquet(f"{tmp_path}/p").collect()) == [("2023-05", 1), ("2023-05", 1), ("2023-06", 2)]
    month = sources.read_month(spark, f"{tmp_path}/p", "2023-05")
    assert [r["cnpj_basico"] for r in month.collect()] == ["1", "2"]
    assert "PartitionFilters: [isnotnull(reference_month" in month._jdf.queryExecution().toString()
    assert len(list((tmp_path / "p/reference_month=2023-05").glob("*.snappy.parquet"))) == 1


def test_ranges_of_a_months_files(spark, tmp_path):
    # one root has a third of all rows; keys come in any order
    rows = spark.range(6000).selectExpr("concat('2023-0', 5 + id % 2) AS reference_month", "lpad(CASE WHEN id % 3 = 0 THEN 7 ELSE id * 7919 % 6000 END, 8, '0') AS cnpj_basico", "lpad(id, 4, '0') AS cnpj_ordem", "'00' AS cnpj_dv", "id AS v")
    sinks.write_panel(rows, f"{tmp_path}/p", files_per_month=5)
    bounds = [(r["reference_month"], tuple(r["lower"]), tuple(r["upper"]), r["n_rows"], r["file"]) for r in sinks.read_bounds(spark, f"{tmp_path}/p").collect()]
    for month in ("2023-05", "2023-06"):
        own = sorted(x[1:4] for x in bounds if x[0] == month)
        assert 5 <= len(own) <= 6 and sum(n for *_, n in own) == 3000 and max(n for *_, n in own) < 1500
        assert all(a[1] < b[0] for a, b in zip(own, own[1:]))  # noqa: B905
    for root, part in (("00000007", "0003"), ("00000004", None), ("99999999", "1")):
        key = {"cnpj_basico": root} | ({"cnpj_ordem": part} if part else {})
        for month in ("2023-05", "2023-06"):
            found = sinks.read_key(spark, f"{tmp_path}/p", month, **key)
            want = rows.where((F.col("reference_month") == month) & (F.col("cnpj_basico") == root) & (F.col("cnpj_ordem") == part if part else F.lit(True)))
            assert sorted(r["v"] for r in found.collect()) == sorted(r["v"] for r in want.collect())
            assert len(found.inputFiles()) <= 1
    # a month that replaces itself has other files; one whose writer broke off before the bounds is read all the same
    sinks.write_panel(rows.where("reference_month = '2023-06'").withColumn("v", -F.col("v")), f"{tmp_path}/p")
    again = sinks.read_bounds(spark, f"{tmp_path}/p").collect()
    assert {r["file"] for r in again if r["reference_month"] == "2023-05"} == {x[4] for x in bounds if x[0] == "2023-05"} and sum(r["n_rows"] for r in again) == 6000
    assert [r["v"] for r in sinks.read_key(spark, f"{tmp_path}/p", "2023-06", cnpj_basico="00000007", cnpj_ordem="0003").collect()] == [-3]
    replaced = rows.where("reference_month = '2023-06'").withColumn("v", F.lit(5)).repartition(2)
    replaced.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("reference_month").parquet(f"{tmp_path}/p")
    assert [r["v"] for r in sinks.read_key(spark, f"{tmp_path}/p", "2023-06", cnpj_basico="00000007", cnpj_ordem="0003").collect()] == [5]
    sinks.write_panel(rows.where("false"), f"{tmp_path}/p")
    assert spark.read.parquet(f"{tmp_path}/p").count() == 6000


def test_coordinates_are_counted_in_the_pass_that_reads_them(spark, tmp_path):
    (tmp_path / "g.csv").write_text("cnpj_basico,tipo_logradouro,logradouro,numero,uf,cidade,bairro,cep,latitude,longitude\n1,R,l,1,SP,x,b,1,abc,1\n1,R,too,few\n1,R,l,1,SP,x,b,1,2,1\n")
    counts = Observation()
    rows = sources.read_places(spark, f"{tmp_path}/g.csv", counts)
    assert rows._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert rows.collect() == sources.read_places(spark, f"{tmp_path}/g.csv").collect()
    assert counts.get == {"n_read": 1, "n_skipped": 2}


def test_side_outputs_csv_and_versions(spark, tmp_path):
    tables = {"empresa": spark.createDataFrame([("1", "n", 1, 1, 1.0, 1, None)], EMPRESA), "estabelecimento": spark.createDataFrame([tuple([None] * 30)], ESTABELECIMENTO)}
    sinks.write_side_outputs(tables, "2023-05", f"{tmp_path}/i")
    assert [len(spark.read.parquet(f"{tmp_path}/i/{n}").columns) for n in ("empresa", "estabelecimento", "estabelecimento_enderecos")] == [3, 12, 11]
    rows = spark.createDataFrame([(2, None), (1, "b"), (3, "a")], "k int, v string")
    sinks.write_csv(rows, f"{tmp_path}/c", ["key", "value"], ["v"], 2, single=True)
    assert next((tmp_path / "c").glob("part-*")).read_text() == "key,value\n3,a\n1,b\n"
    table = sinks.KeyedTable(spark, f"{tmp_path}/t")
    with pytest.raises(LookupError):
        table.read()
    assert table.change(lambda r: r.where("k > 1"), rows) == 1 and table.change(lambda r: r.where("k > 2")) == 2
    assert [r["k"] for r in table.read().collect()] == [3]


def test_command_line(capsys):
    cli.main(["months", "2023-11", "2024-01"])
    assert capsys.readouterr().out.split() == ["2023-11", "2023-12", "2024-01"]
