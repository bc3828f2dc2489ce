"""Refusals, and inputs that once gave wrong rows."""

import os
import subprocess
import sys
import zipfile

import pytest
from pyspark.sql import functions as F

from igarape import jobs
from igarape.functions.numeric import decimal_comma_number
from igarape.functions.text import compact_slug, strip_accents, to_ascii
from igarape.models.evaluation import fold_segments
from igarape.operators.lookup import require_all_found
from igarape.operators.ordering import with_place
from igarape.plans.finance import finance_silver
from igarape.plans.gold import joined_on_grid
from igarape.plans.service_indicators import service_by_year
from igarape.plans.water_quality import quality_by_parameter
from igarape.sinks.tables import replace_with_csv_twin
from igarape.sources.delimited import read_archives, read_by_header
from igarape.sources.stations import read_stations

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
HEADER = "ANO_CMPT,MES_CMPT,MUNIC_RES,DIAG_PRINC,DIAS_PERM,VAL_TOT\n"


def listing(folder):
    return {p: p.stat().st_mtime_ns for p in folder.rglob("*") if p.is_file()}


def test_a_failed_job_leaves_the_old_table(spark, tmp_path):
    places = str(os.path.join(ROOT, "config", "municipalities.csv"))
    source, out = tmp_path / "csv", tmp_path / "out"
    source.mkdir()
    (source / "RDPA2001.csv").write_text(HEADER + "2020,1,150140,A09,1,10.5\n")
    jobs.run_admissions(spark, str(source), places, str(out))
    before = listing(out)
    assert before
    (source / "RDPA2001.csv").write_text(HEADER + "2020,1,999999,A09,1,10.5\n")
    with pytest.raises(ValueError, match="no admission"):
        jobs.run_admissions(spark, str(source), places, str(out))
    assert listing(out) == before
    (source / "RDPA2001.csv").write_text(HEADER.replace("DIAG_PRINC", "X") + "2020,1,150140,A09,1,10.5\n")
    with pytest.raises(ValueError, match="RDPA2001.csv.*DIAG_PRINC"):
        jobs.run_admissions(spark, str(source), places, str(out))
    assert listing(out) == before


def test_gold_refuses_two_rows_of_a_source_and_skips_nan(spark):
    places = spark.createDataFrame([("1",), ("2",)], "cod_mun string")
    a = spark.createDataFrame([("1", 2020, 10.0, float("nan")), ("2", 2020, 1.0, 2.0)], "cod_mun string, ano int, x double, y double")
    b = spark.createDataFrame([("1", 2021, 5)], "cod_mun string, ano int, z int")
    rows = {(r.cod_mun, r.ano): (r.x, r.y, r.z) for r in joined_on_grid(places, [a, b]).collect()}
    assert rows == {("1", 2020): (10.0, None, None), ("2", 2020): (1.0, 2.0, None), ("1", 2021): (None, None, 5), ("2", 2021): (None, None, None)}
    twice = a.union(spark.createDataFrame([("1", 2020, 80.0, 20.0)], a.schema))
    with pytest.raises(Exception, match="several rows for 1, 2020"):
        joined_on_grid(places, [twice, b])


def test_codes_of_six_and_seven_digits_are_one(spark, dimension):
    columns = "cod_mun string, ano int, periodo int, numero_indicador double, numerador double, denominador double"
    rows = [("150140", 2020, 2, 2.1, 9.0, 1.0), ("1501402", 2020, 1, 2.1, 4.0, 1.0), ("150140", 2020, 1, 2.5, 1.0, 2.0)]
    found = finance_silver(spark.createDataFrame(rows, columns), dimension).collect()
    assert [(r.cod_mun, r.ano, r.despesa_saude_pc, r.pct_despesa_investimentos_saude) for r in found] == [("1501402", 2020, 4.0, 50.0)]
    rows = [("150140", 2020, 10.0, 90.0), ("1501402", 2020, 80.0, None)]
    service = spark.createDataFrame(rows, "cod_mun string, ano int, idx_atend_agua_total double, idx_coleta_esgoto double")
    found = service_by_year(service, dimension).collect()
    assert len(found) == 1 and (found[0].idx_atend_agua_total, found[0].idx_coleta_esgoto) in [(10.0, 90.0), (80.0, None)]


def test_absent_percentiles_do_not_lower_the_mean(spark, dimension):
    rows = [("1501402", 2020, "p", 1.0, 1.0, 0.0, 4.0), ("150140", 2020, "p", 1.0, 0.0, 1.0, None)]
    names = "cod_mun string, ano int, parametro string, amostras_total double, amostras_conformes double, amostras_nao_conformes double, percentil_95 double"
    (row,) = quality_by_parameter(spark.createDataFrame(rows, names), dimension).collect()
    assert (row.percentil_95, row.amostras_total, row.pct_conformes_param) == (4.0, 2.0, 50.0)


def test_missing_codes_are_counted(spark, dimension):
    rows = spark.createDataFrame([(str(i),) for i in range(150)] * 2, "cod_mun string")
    with pytest.raises(ValueError, match="150 codes"):
        require_all_found(rows, dimension, "cod_mun")


def value(spark, column):
    return spark.range(1).select(column).first()[0]


def test_strict_parsing_and_slugs(spark):
    texts = {"12abc": None, "1e3": 1000.0, "1,5": 1.5, "1.5": 1.5, "1.234,5": None, "": None, " -2,0 ": -2.0}
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    assert {r.t: r.x for r in rows.select("t", decimal_comma_number("t").alias("x")).collect()} == texts
    assert value(spark, compact_slug(F.lit("a\nb  Ção_(x)"))) == "ab_cao_x"
    assert value(spark, to_ascii(F.lit("a b c　d"))) == "a b c d"
    assert value(spark, strip_accents(F.lit("①㎏ﬁ½Ά\U0001d400᪰"))) == "1kgfi1⁄2ΑA"


def test_quoted_line_breaks_read_alike_in_both_readers(spark, tmp_path):
    text = 'a;b\n1;"x\ny"\n2;z\n'
    (tmp_path / "f.csv").write_text(text)
    with zipfile.ZipFile(tmp_path / "f.zip", "w") as archive:
        archive.writestr("f.csv", text)
    wanted = {"a": ["a"], "b": ["b"]}
    plain = read_by_header(spark, f"file://{tmp_path}/f.csv", wanted, ";", multi_line=True)
    packed = read_archives(spark, f"file://{tmp_path}/f.zip", wanted)
    rows = sorted(tuple(r)[:2] for r in plain.collect())
    assert rows == sorted(tuple(r)[:2] for r in packed.collect()) == [("1", "x\ny"), ("2", "z")]


def test_station_columns_in_another_order(spark, tmp_path):
    lines = ["preamble;x"] * 8 + ["Hora UTC;Data;PRECIPITAÇÃO TOTAL, HORÁRIO (mm)", "0000 UTC;2020/01/01;1,5"]
    (tmp_path / "INMET_N_PA_A201_X.CSV").write_bytes("\n".join(lines).encode("latin-1"))
    rows = read_stations(spark, f"file://{tmp_path}/*.CSV").collect()
    assert [(r.estacao, r.data, r.chuva_mm) for r in rows] == [("A201", "2020/01/01", "1,5")]


def test_csv_twin_keeps_the_order(spark, tmp_path):
    rows = spark.range(1000).withColumn("x", F.xxhash64("id")).repartition(7)
    replace_with_csv_twin(rows, f"{tmp_path}/t.parquet", f"{tmp_path}/t.csv", ["x"])
    files = sorted((tmp_path / "t.csv").glob("part-*.csv"))
    found = [int(line.split(",")[1]) for f in files for line in f.read_text().splitlines()[1:]]
    assert found == sorted(found) and len(found) == 1000


def test_places_and_folds(spark):
    rows = spark.range(500).select((F.col("id") * 37 % 500).alias("k")).repartition(6)
    assert all(r.k == r.place for r in with_place(rows, [F.col("k")], "place").collect())
    assert with_place(rows.limit(0), [F.col("k")], "place").count() == 0
    sizes = [(1_000_000, 1), (7, 3), (1, 5_000_000)]
    segments = fold_segments(sizes, 4)
    assert len(segments) < 12  # few, however many groups there are


SHIPPED = """
import sys
sys.path.insert(0, sys.argv[1])
from igarape.session import build_session
from igarape.sources.delimited import read_by_header
spark = build_session(master="local[1]", **{"spark.ui.enabled": "false", "spark.checkpoint.dir": sys.argv[2]})
assert read_by_header(spark, "file://" + sys.argv[3], {"a": ["a"]}).first().a == "1"
"""


def test_workers_get_the_package(tmp_path):
    """Only the driver has the package on its path."""
    (tmp_path / "f.csv").write_text("a,b\n1,2\n")
    arguments = [ROOT, str(tmp_path / "shared"), str(tmp_path / "f.csv")]
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", SHIPPED, *arguments], check=True, timeout=180, cwd=tmp_path, env=env)
