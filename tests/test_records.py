"""Records with line breaks in quotes, from files that are cut into splits."""

import random
import zipfile

import numpy as np
import pyarrow as pa
import pytest

from panelforge.schemas import CNAE, EMPRESA
from panelforge.sources import files as sources
from panelforge.sources import records

TEXT = '"1";"a\nb"\n2;c\n\n"3";"d ""e""\r\n;\n"\r\n4";x"y;z\n5;"say ""\n6;"\n7;\n"8";"é\n\n\nf"\n9;"end\n'


def _by_hand(text: str) -> list[str]:
    """Records by reading letter by letter: a quote opens a field at its beginning only."""
    out, record, state = [], "", "begin"  # of a field; then in, quote (in it) or plain
    for x in text:
        if x == "\n" and state != "in":
            out, record, state = [*out, record], "", "begin"
            continue
        record += x
        if state == "in":
            state = "quote" if x == '"' else "in"
        elif x == ";":
            state = "begin"
        elif x == '"' and state in ("begin", "quote"):
            state = "in"
        else:
            state = "plain"
    return [r.removesuffix("\r") for r in [*out, record] if r.removesuffix("\r")]


def test_lines_and_turns_are_those_of_a_reader_of_letters():
    rng = random.Random(5)
    for _ in range(400):
        text = "".join(rng.choice('a";\n"') for _ in range(rng.randint(0, 40)))
        lines = pa.array(text.removesuffix("\n").split("\n"), pa.string())
        turns = records.turns_of(lines, records.open_pattern(";"))
        for step in (1, 3, 100):  # batches
            joiner, got = records.Joiner(), []
            for a in range(0, len(lines), step):
                alone, several, ends = joiner.feed(lines.slice(a, step), tuple(t[a : a + step] for t in turns))
                assert not ends
                got += alone.to_pylist() + several
            got += [joiner.rest()] if joiner.rest() is not None else []
            assert sorted(x for x in got if x) == sorted(_by_hand(text.removesuffix("\n"))), text
    assert [t.dtype for t in turns] == [np.bool_] * 2


@pytest.fixture
def split_size(spark):
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    yield lambda n: spark.conf.set(name, str(n))
    spark.conf.set(name, before)


def _rows(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def test_a_file_cut_at_every_byte_is_read_as_one_that_is_not_cut(spark, tmp_path, split_size):
    (tmp_path / "a.csv").write_bytes(TEXT.encode("latin-1"))
    want = sorted(_by_hand(TEXT.removesuffix("\n")))
    assert len(want) == 8 and 'é' in "".join(want)
    for n in (*range(1, 8), 11, 17, 23, 31, 48, len(TEXT)):  # the smallest cut at every byte
        split_size(n)
        assert sorted(r["line"] for r in records.read_records(spark, f"{tmp_path}/a.csv").collect()) == want, n


def test_as_the_unsplittable_reader(spark, tmp_path, split_size):
    rows = [(k, "x" * (k % 7) + "\n" * (k % 3) + ('"q";' if k % 5 else "\r\n,")) for k in range(3000)]
    (tmp_path / "two").mkdir()
    for name in "ab":
        (tmp_path / "two" / name).write_text("".join('"{}{}";"{}"\n'.format(name, k, v.replace('"', '""')) for k, v in rows), newline="")
    want = _rows(spark.read.csv(f"{tmp_path}/two", schema=CNAE, sep=";", quote='"', escape='"', multiLine=True, lineSep="\n"))
    assert len(want) == 6000 and sum("\n" in r[1] for r in want) > 3000
    for n, few in ((700, 10), (700, 10_000), (5_000, 10_000), (10**8, 10)):
        split_size(n)
        before, records.BROADCAST_SPLITS = records.BROADCAST_SPLITS, few
        try:
            assert _rows(sources.read_dump(spark, f"{tmp_path}/two", CNAE, multiline=True)) == want
            named = sources.read_dump(spark, f"{tmp_path}/two", CNAE, multiline=True, file=True)
            assert {(r["file"][-1], r["codigo"][0]) for r in named.collect()} == {("a", "a"), ("b", "b")}
        finally:
            records.BROADCAST_SPLITS = before


def test_changed_splits_are_noticed(spark, tmp_path, split_size):
    (tmp_path / "a.csv").write_bytes(TEXT.encode("latin-1"))
    split_size(30)
    found = records.read_records(spark, f"{tmp_path}/a.csv")
    split_size(20)
    with pytest.raises(Exception, match="splits have changed"):
        found.collect()


def test_empty_files_and_registries_with_zips(spark, tmp_path):
    (tmp_path / "none.csv").write_bytes(b"")
    assert records.read_records(spark, f"{tmp_path}/none.csv").collect() == []
    lines = '"1";"two\r\nlines; ""\n""";1;1;"1,5";1;x\r\n"2";"n";1;1;"1,0";1;\r\n"3";"too";1;1;"1\n,0";1;"many";"fields"\r\n'.encode()
    (tmp_path / "in").mkdir()
    (tmp_path / "in/K1.EMPRECSV").write_bytes(lines)
    with zipfile.ZipFile(tmp_path / "in/Empresas0.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("K2.EMPRECSV", lines.replace(b'"1";', b'"4";').replace(b'"2";', b'"5";'))
    found = sources.read_registry(spark, f"{tmp_path}/in", multiline=True)["empresa"]
    assert found.schema == EMPRESA
    name = 'two\r\nlines; "\n"'
    assert _rows(found.select("cnpj_basico", "razao_social", "capital_social")) == [("1", name, 1.5), ("2", "n", 1.0), ("4", name, 1.5), ("5", "n", 1.0)]
