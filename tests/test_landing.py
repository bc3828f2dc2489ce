"""Archives, landed answers and totals kept per file."""

import json
import random
import zipfile

import pytest

from igarape import jobs
from igarape.__main__ import parser
from igarape.operators.accumulate import PartialStates
from igarape.plans.water_quality import read_water_samples
from igarape.schemas import FINANCE_PAYLOAD
from igarape.sources import payloads
from igarape.sources.delimited import read_archives, read_by_header
from igarape.sources.payloads import array_elements, read_payloads
from tests.conftest import MUNICIPALITIES
from tests.test_sources import WATER_ROW, water_text


def archive(path, members):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as target:
        for name, data in members.items():
            target.writestr(name, data)


@pytest.mark.parametrize("packed", [False, True])
def test_a_water_file_without_a_needed_column_is_an_error(spark, tmp_path, packed):
    for name, columns in (("good", None), ("bad", [c for c in WATER_ROW if c != "Valor"])):
        text = water_text([{}], columns)
        if packed:
            archive(tmp_path / f"{name}.zip", {f"in/{name}.CSV": text, "note.txt": "x"})
        else:
            (tmp_path / f"{name}.csv").write_bytes(text)
    with pytest.raises(ValueError, match=r"columns missing in 1 files: .*bad.* \(valor_texto\)"):
        read_water_samples(spark, str(tmp_path))


def test_members_read_like_files(spark, tmp_path):
    rng = random.Random(1)
    lines = ["x;long;y;z"]
    for i in range(3000):
        lines.append(rng.choice([f"{i};a;é{i};z", f'{i};"q ""{i}"" ;\nline";y;', f"{i};;", f"{i}", f"{i};a;b;c;surplus;more", f'{i};"";y;z']))
    lines.append(f"big;{'w' * 300_000};y;z")
    data = ("\n".join(lines) + "\n").encode("latin-1")
    (tmp_path / "plain.csv").write_bytes(data)
    archive(tmp_path / "packed.zip", {"a.csv": data, "empty.csv": b"", "only.csv": b"z;x\n"})
    wanted = {"y": ["y"], "long": ["nothing", "long"], "x": ["x"], "none": ["none"]}
    plain = read_by_header(spark, f"{tmp_path}/plain.csv", wanted, ";", "ISO-8859-1", multi_line=True)
    packed = read_archives(spark, f"{tmp_path}/packed.zip", wanted, row_bytes=1 << 20)
    assert packed.columns == plain.columns
    key = lambda r: r[2]
    # Spark gives NULL for an empty field, the archive reader an empty text.
    rows = [sorted([tuple(v or None for v in r[:4]) for r in df.collect()], key=key) for df in (plain, packed)]
    assert len(rows[0]) == 3001 and rows[0] == rows[1]
    assert len(rows[1][-1][1]) == 300_000 or any(len(r[1] or "") == 300_000 for r in rows[1])
    assert {r.fonte_arquivo for r in packed.collect()} == {"packed.zip"}


def test_broken_bytes_and_archives_without_members(spark, tmp_path):
    archive(tmp_path / "a.zip", {"a.csv": b"\xef\xbb\xbfx;y\n1;\xff\xe9\n"})
    archive(tmp_path / "b.zip", {"readme.txt": b"no"})
    with pytest.warns(UserWarning, match="1 archives without CSV members: .*b.zip"):
        found = read_archives(spark, f"{tmp_path}/*.zip", {"x": ["x"], "y": ["y"]}, encoding="UTF-8", required=["x", "y"])
    assert [tuple(r)[:2] for r in found.collect()] == [("1", "��")]


def elements(text, chunk):
    data, at = text.encode() if isinstance(text, str) else text, [0]

    def read(n):
        at[0] += n
        return data[at[0] - n : at[0]]

    return list(array_elements(read, chunk))


@pytest.mark.parametrize("chunk", [1, 2, 7, 1000])
def test_elements_of_a_streamed_array(chunk):
    items = [{"a": 'x",]é\\"', "b": [1, {"c": None}]}, 12345, -1.5e10, "t", None, [], True, "日本"]
    for text in (json.dumps(items, ensure_ascii=False), "﻿ \n" + json.dumps(items, indent=3) + "\n"):
        found = elements(text, chunk)
        assert [json.loads(e) for e, rest in found] == items and not any(rest for _, rest in found)
    assert elements("[]", chunk) == elements(" ", chunk) == elements("", chunk) == []
    for text, whole, rest in (('[1, 2, {"a": 3', 2, '{"a": 3'), ('{"a": 1}', 0, '{'), ("[1 2]", 1, "2"), ("[1,", 1, "")):
        found = elements(text, chunk)
        assert len(found) == whole + 1 and found[-1][0] is None and found[-1][1].startswith(rest[:1])


def test_broken_arrays_are_named_or_kept_apart(spark, tmp_path):
    good = [{"numero_indicador": "2.1", "numerador": 4.0, "denominador": 2.0}]
    (tmp_path / "150140_2020_2.json").write_text(json.dumps(good))
    (tmp_path / "150080_2020_2.json").write_text(json.dumps(good * 3)[:-9])
    (tmp_path / "150010_2020_2.json").write_text("")
    with pytest.raises(Exception, match="not a whole JSON array: 150080_2020_2.json"):
        read_payloads(spark, f"{tmp_path}/*.json", FINANCE_PAYLOAD).collect()
    found = read_payloads(spark, f"{tmp_path}/*.json", FINANCE_PAYLOAD, corrupt="rest")
    kept = [(r.arquivo, r.posicao, r.numerador, bool(r.rest)) for r in found.orderBy("arquivo", "posicao").collect()]
    assert kept == [("150080_2020_2.json", 0, 4.0, False), ("150080_2020_2.json", 1, 4.0, False), ("150080_2020_2.json", 2, None, True), ("150140_2020_2.json", 0, 4.0, False)]


def test_landed_answers_become_a_bronze_table(spark, tmp_path):
    indicators = [{"numero_indicador": n, "ds_indicador": "d", "numerador": 5.0, "denominador": 2.0, "indicador_calculado": 2.5} for n in ("2.1", "9.9")]
    (tmp_path / "in").mkdir()
    (tmp_path / "in/150140_2020_2.json").write_text(json.dumps(indicators))
    (tmp_path / "m.csv").write_text(MUNICIPALITIES, encoding="utf-8")
    jobs.run_payloads(spark, "finance", f"{tmp_path}/in/*.json", f"{tmp_path}/bronze/f.csv")
    jobs.run_finance(spark, f"{tmp_path}/bronze/f.csv", f"{tmp_path}/m.csv", f"{tmp_path}/silver")
    row = spark.read.parquet(f"{tmp_path}/silver").first()
    assert (row.cod_mun, row.ano, row.despesa_saude_pc) == ("1501402", 2020, 2.5)
    titles = {"D1C": "Código", "D1N": "n", "D3C": "Ano", "V": "Valor"}
    people = [titles, {"D1C": "1501402", "D1N": "Belém", "D3C": "2020", "V": "123"}]
    (tmp_path / "pop.json").write_text(json.dumps(people))
    jobs.run_payloads(spark, "population", f"{tmp_path}/pop.json", f"{tmp_path}/bronze/p/sidra6579_pop_2020.csv")
    assert payloads.population_records(spark, f"{tmp_path}/pop.json").count() == 1
    assert spark.read.option("header", True).csv(f"{tmp_path}/bronze/p/sidra6579_pop_2020.csv").first().valor == "123"
    args = parser().parse_args(["payloads", "--kind", "subfunctions", "--input", "i", "--out", "o"])
    assert (args.kind, args.input, args.out) == ("subfunctions", "i", "o")


HEADER = "ANO_CMPT,MES_CMPT,MUNIC_RES,DIAG_PRINC,DIAS_PERM,VAL_TOT\n"


def test_new_files_are_added_without_reading_old_ones(spark, tmp_path, monkeypatch):
    rng = random.Random(5)
    (tmp_path / "m.csv").write_text(MUNICIPALITIES, encoding="utf-8")
    source = tmp_path / "csv"
    source.mkdir()

    def write(name, n, extra=""):
        lines = [f"20{name[:2]},{int(name[2:])},{rng.choice(['150140', '1500800', '999999'])},{rng.choice(['A09', 'J18'])},{rng.randrange(9)},{rng.randrange(99)}.5" for _ in range(n)]
        (source / f"RDPA{name}.csv").write_text(HEADER + "\n".join(lines) + extra + "\n")

    reads = []
    from igarape.plans import admissions

    real = admissions.read_admissions
    monkeypatch.setattr(admissions, "read_admissions", lambda s, paths, *x, **y: (reads.append(paths), real(s, paths, *x, **y))[1])

    def step(files):
        reads.clear()
        jobs.run_admissions(spark, str(source), f"{tmp_path}/m.csv", f"{tmp_path}/out", states=f"{tmp_path}/states")
        read = sorted(p.rsplit("/", 1)[-1] for paths in reads for p in paths)
        assert read == sorted(f"RDPA{f}.csv" for f in files)
        jobs.run_admissions(spark, str(source), f"{tmp_path}/m.csv", f"{tmp_path}/full")
        rows = [sorted(map(tuple, spark.read.parquet(f"{tmp_path}/{t}").select("cod_mun", "ano", "mes", "internacoes_total", "internacoes_hidricas", "dias_perm_total", "dias_perm_hidricas", "valor_total", "valor_hidricas", "municipio").collect())) for t in ("out", "full")]
        assert rows[0] == rows[1] and rows[0]

    write("2001", 200)
    (source / "RDPA2002.csv").write_text(HEADER)  # known, though without rows
    step(["2001", "2002"])
    step([])
    write("2003", 150)
    step(["2003"])
    write("2001", 40, "\n2020,1,150140,A09,1,1.5")  # changed
    step(["2001"])
    (source / "RDPA2003.csv").unlink()
    step([])


def test_states_know_files_by_name(spark, tmp_path):
    from pyspark.sql import functions as F

    states = PartialStates(spark, f"{tmp_path}/states", ["k"], {"x": F.col("x")})
    assert states.absorbed() is None
    rows = spark.createDataFrame([("01", "a", 1.0), ("01", "a", None), ("1 é=2", "a", 3.0), ("1 é=2", None, 5.0)], "f string, k string, x double")
    files = spark.createDataFrame([("01", 1, 1), ("1 é=2", 1, 1), ("none", 1, 1)], "_file string, _size long, _changed long")
    for _ in range(2):
        states.absorb(rows, files, "f")
        found = {r.k: r.asDict() for r in states.total().collect()}
        assert found["a"] == {"k": "a", "rows": 3, "count_x": 2, "sum_x": 4.0, "low_x": 1.0, "high_x": 3.0}
        assert found[None]["rows"] == 1
        assert sorted(r[0] for r in states.absorbed().collect()) == ["01", "1 é=2", "none"]
    states.withdraw(["1 é=2"])
    assert [r.asDict() for r in states.total().collect()] == [{"k": "a", "rows": 2, "count_x": 1, "sum_x": 1.0, "low_x": 1.0, "high_x": 1.0}]
    assert sorted(r[0] for r in states.absorbed().collect()) == ["01", "none"]
    (tmp_path / "p").mkdir()
    (tmp_path / "q").mkdir()
    for folder in "pq":
        (tmp_path / folder / "same.csv").write_text("x")
    with pytest.raises(ValueError, match="same.csv"):
        states.update(f"{tmp_path}/[pq]/*.csv", lambda paths: rows, "f")


def test_files_without_a_header_line_are_left_out(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    (tmp_path / "b.csv").write_text("")
    wanted = {"x": ["x"], "y": ["y"]}
    assert [tuple(r) for r in read_by_header(spark, f"{tmp_path}/*.csv", wanted).collect()] == [("1", "2", "a.csv")]
    (tmp_path / "c.csv").write_text("\nx,y\n3,4\n")
    assert [tuple(r) for r in read_by_header(spark, f"{tmp_path}/*.csv", wanted).collect()] == [("1", "2", "a.csv")]
    for i in range(30):
        (tmp_path / f"n{i:02d}.csv").write_text("x,z\n1,2\n")
    with pytest.raises(ValueError, match="columns missing in 30 files") as error:
        read_by_header(spark, f"{tmp_path}/*.csv", wanted, required=["x", "y"])
    assert str(error.value).count(" (y)") == 20
