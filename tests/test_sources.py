"""Readers and writers on small files written here."""

import datetime
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from igarape.constants import WATER_HEADERS
from igarape.functions.numeric import decimal_comma
from igarape.plans import water_quality
from igarape.plans.admissions import read_admissions
from igarape.plans.climate import climate_silver
from igarape.plans.population import population_silver, read_population
from igarape.sinks.tables import (
    export_csv,
    generation_time,
    replace_table,
    replace_touched_partitions,
    replace_with_csv_twin,
    stamped,
)
from igarape.sources import payloads
from igarape.sources.delimited import read_by_header
from igarape.sources.dimension import municipality_dimension
from igarape.sources.sheets import column_names, header_rows, repaired_cells, sheet_layout, sheet_records
from igarape.sources.stations import read_stations


def test_dimension(municipalities, dimension):
    assert dimension.count() == 8
    assert municipality_dimension(municipalities, members_only=False).count() == 9
    assert dimension.filter("name = 'Belém'").first().cod_mun == "1501402"


def test_headers_that_differ_between_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("X;Y;Z\n1;2;3\n4;\"5;5\";6\n", encoding="utf-8")
    (tmp_path / "b.csv").write_text("Z;extra;X\n9;8;7\n", encoding="utf-8")
    (tmp_path / "c.csv").write_text("X;Y;Z\n", encoding="utf-8")
    (tmp_path / "d.csv").write_text("", encoding="utf-8")
    rows = read_by_header(spark, str(tmp_path), {"x": ["X"], "y": ["Y"]}, separator=";")
    assert sorted(tuple(r) for r in rows.collect()) == [("1", "2", "a.csv"), ("4", "5;5", "a.csv"), ("7", None, "b.csv")]
    assert read_by_header(spark, str(tmp_path / "d.csv"), {"x": ["X"]}).count() == 0


def test_only_wanted_columns_are_read(spark, tmp_path):
    header = "ANO_CMPT,MES_CMPT,MUNIC_RES,DIAG_PRINC,DIAS_PERM,VAL_TOT,OUTRA"
    (tmp_path / "RDPA2001.csv").write_text(header + "\n2020,1,150140,A09,3,10.5,zz\n", encoding="utf-8")
    rows = read_admissions(spark, str(tmp_path / "RDPA*.csv"))
    plan = rows.filter("MUNIC_RES = '150140'").select("VAL_TOT")._jdf.queryExecution().executedPlan().toString()
    assert rows.first().DIAG_PRINC == "A09"
    assert "ReadSchema: struct<c2:string,c5:string>" in plan and "PushedFilters: [IsNotNull(c2), EqualTo(c2,150140)]" in plan


WATER_ROW = {
    "UF": "PA",
    "Código IBGE": "150140",
    "Município": "BELÉM",
    "Ano de referência": "2020.0",
    "Mês de referência": "3",
    "Parâmetro": "Turbidez (uT)",
    "Campo": "Número de amostras analisadas",
    "Valor": "1.234,5",
    "Ponto de Monitoramento": "",
    "Tipo da Forma de Abastecimento": "SAA",
    "Nome da Forma de Abastecimento": "Centro",
    "Código Forma de abastecimento": "S1",
    "Nome da ETA / UTA": " ",
    "Sigla da Instituição": "XX",
    "Nome da Instituição": "Companhia",
}


def water_text(rows, columns=None):
    columns = columns or list(WATER_ROW)
    lines = [";".join(columns)] + [";".join({**WATER_ROW, **r}[c] for c in columns) for r in rows]
    return ("\n".join(lines) + "\n").encode("latin-1")


def write_water(folder):
    folder.mkdir(exist_ok=True)
    basic = [
        {},
        {"Campo": "<= 5,0", "Valor": "900"},
        {"Campo": "> 6,0", "Valor": "100"},
        {"Campo": "Percentil 95", "Valor": "4,5"},
        {"Campo": "outro", "Valor": "7"},
        {"Código IBGE": "1500800", "Parâmetro": "Coliformes totais", "Campo": "Ausência", "Valor": "30"},
        {"Código IBGE": "1500800", "Parâmetro": "Coliformes totais", "Campo": "Presença", "Valor": "10"},
        {"UF": "AM"},
        {"Código IBGE": "9999999"},
        {"Valor": "na"},
        {"Ano de referência": "x"},
        {"Campo": " "},
        {"Código IBGE": ""},
    ]
    other = [{"Parâmetro": "Nitrato", "Campo": "Percentil 95", "Valor": "1.5"}]
    (folder / "controle_basicos_2020.csv").write_bytes(water_text(basic))
    with zipfile.ZipFile(folder / "controle_demais_2020.zip", "w") as archive:
        archive.writestr("dados/parte1.csv", water_text(other, list(reversed(WATER_ROW))))
        archive.writestr("dados/parte2.CSV", water_text([{**other[0], "Mês de referência": "4"}]))
        archive.writestr("leia-me.txt", b"nada")
    with zipfile.ZipFile(folder / "vazio.zip", "w") as archive:
        archive.writestr("leia-me.txt", b"nada")


def test_water_quality_from_csv_and_zip(spark, dimension, tmp_path):
    write_water(tmp_path / "water")
    raw = water_quality.read_water_samples(spark, str(tmp_path / "water"))
    assert set(raw.columns) == {*WATER_HEADERS, "fonte_arquivo"}
    assert raw.count() == 15
    samples = water_quality.classified_samples(raw, dimension)
    assert samples.count() == 9
    silver = {(r.parametro, r.mes): r for r in water_quality.water_quality_silver(samples).collect()}
    turbidity = silver[("turbidez", 3)]
    assert (turbidity.amostras_total, turbidity.amostras_conformes, turbidity.amostras_nao_conformes) == (1234.5, 900.0, 100.0)
    assert (turbidity.percentil_95, turbidity.amostras_sem_classificacao, turbidity.pct_conformes) == (4.5, 7.0, 90.0)
    assert (turbidity.eta_uta_nome, turbidity.municipio_alvo, turbidity.dataset) == ("N/A", "Belém", "parametros_basicos")
    coliforms = silver[("coliformes_totais", 3)]
    assert (coliforms.amostras_total, coliforms.pct_conformes) == (40.0, 75.0)
    nitrate = silver[("nitrato", 4)]
    assert (nitrate.fonte_arquivo, nitrate.dataset, nitrate.percentil_95) == ("controle_demais_2020.zip", "demais_parametros", 15.0)
    assert nitrate.pct_conformes is None


def test_water_quality_needs_files(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        water_quality.read_water_samples(spark, str(tmp_path))


STATION_HEADER = (
    "Data;Hora UTC;PRECIPITAÇÃO TOTAL, HORÁRIO (mm);PRESSAO ATMOSFERICA AO NIVEL DA ESTACAO, HORARIA (mB);"
    "RADIACAO GLOBAL (Kj/m²);TEMPERATURA DO AR - BULBO SECO, HORARIA (°C);VENTO, VELOCIDADE HORARIA (m/s);"
)


def write_stations(folder):
    preamble = ["REGIAO:;N", "UF:;PA", "ESTACAO:;X", "CODIGO (WMO):;A201", "LATITUDE:;-1,4", "LONGITUDE:;-48,4",
                "ALTITUDE:;21", "DATA DE FUNDACAO:;2003-01-20"]
    new = ["2020/01/01;0000 UTC;,4;1009,1;-9999;25,3;-9999;", "2020/01/01;0100 UTC;-9999;1008;3200,5;33;1,5;"]
    old = ["2019-12-31;23:00;1,5;;;31,9;0;", "2019-12-31;xx;1,5;;;31,9;0;"]
    for year, name, header, lines in [
        ("2020", "INMET_N_PA_A201_BELEM_2020.CSV", STATION_HEADER, new),
        ("2019", "INMET_N_PA_A202_CASTANHAL_2019.CSV", STATION_HEADER.replace("Data;Hora UTC", "DATA (YYYY-MM-DD);HORA (UTC)"), old),
        ("2019", "INMET_N_PA_SEMCODIGO_2019.CSV", STATION_HEADER, new),
    ]:
        path = folder / year
        path.mkdir(parents=True, exist_ok=True)
        (path / name).write_bytes(("\n".join([*preamble, header, *lines]) + "\n").encode("latin-1"))


def test_station_files(spark, tmp_path):
    write_stations(tmp_path)
    silver = climate_silver(read_stations(spark, f"{tmp_path}/*/INMET_N_PA_*.CSV"))
    rows = {r.timestamp_utc: r for r in silver.collect()}
    assert sorted(rows) == [datetime.datetime(2019, 12, 31, 23), datetime.datetime(2020, 1, 1, 0), datetime.datetime(2020, 1, 1, 1)]
    first, second = rows[datetime.datetime(2020, 1, 1, 0)], rows[datetime.datetime(2020, 1, 1, 1)]
    assert (first.estacao, first.chuva_mm, first.temp_c, first.radiacao_global_kj_m2, first.vento_vel_ms) == ("A201", 0.4, 25.3, None, None)
    assert (second.chuva_mm, second.radiacao_global_kj_m2, second.umid_rel_pct) == (None, 3200.5, None)
    assert rows[datetime.datetime(2019, 12, 31, 23)].estacao == "A202"


def test_population_files(spark, tmp_path):
    header = "municipio_codigo,municipio_nome,ano,variavel_codigo,variavel_nome,unidade_codigo,unidade_nome,valor"
    (tmp_path / "sidra6579_pop_2020.csv").write_text(f"{header}\n1501402,Belém (PA),2020,9324,Pop,45,Pessoas,1499641\n")
    (tmp_path / "sidra6579_pop_2022.csv").write_text(header + "\n")
    (tmp_path / "sidra6579_pop_2023.csv").write_text("")
    rows = population_silver(read_population(spark, f"{tmp_path}/sidra6579_pop_*.csv"))
    assert [tuple(r) for r in rows.collect()] == [(1501402, 2020, 1499641)]
    assert [f.dataType.simpleString() for f in rows.schema] == ["int", "int", "int"]
    with pytest.raises(ValueError):
        read_population(spark, f"{tmp_path}/sidra6579_pop_2022.csv")


def test_payloads(spark, tmp_path):
    def put(name, content):
        (tmp_path / name).write_text(json.dumps(content))
        return str(tmp_path / name)

    indicators = put("150140_2020_2.json", [
        {"numero_indicador": 2.1, "ds_indicador": "d", "numerador": 10, "denominador": 4, "indicador_calculado": 2.5},
        {"numero_indicador": 9.9, "ds_indicador": "x"},
    ])
    rows = payloads.finance_indicators(spark, indicators).collect()
    assert [(r.cod_mun, r.ano, r.periodo, r.numero_indicador, r.valor) for r in rows] == [(150140, 2020, 2, "2.1", 2.5)]
    sub = payloads.finance_subfunctions(spark, put("150140_2021_2.json", [{"quadro": "q", "valor1": 3, "lixo": 1}])).first()
    assert (sub.ano, sub.quadro, sub.valor1, sub.valor10) == (2021, "q", "3", None)
    people = put("pop.json", [{"D1C": "Município (Código)", "V": "Valor"}, {"D1C": "1501402", "D3C": "2020", "V": "9"}])
    assert [(r.municipio_codigo, r.ano, r.valor) for r in payloads.population_records(spark, people).collect()] == [("1501402", "2020", "9")]
    assert payloads.population_records(spark, put("empty.json", [])).count() == 0
    listed = put("resources.json", [{"format": "csv", "url": "u1"}, {"format": "PDF", "url": "u2"}, {"format": "ZIP", "url": ""}, {"url": "u3"}])
    assert [(r.format, r.url) for r in payloads.wanted_resources(spark, listed).collect()] == [("CSV", "u1")]


def sheet_cells(file, sheet, rows):
    return [(file, sheet, i, j, t) for i, row in enumerate(rows) for j, t in enumerate(row) if t is not None]


WATER_SHEET = [
    ["Relatório", None, None, None, None, None],
    ["- CÃ³digo do MunicÃ\xadpio", "MunicÃ\xadpio", "UF", "Índice de atendimento total de água\n(%)", "Tarifa", "Tarifa"],
    ["cod", "nome", "uf", "IN055", "IN004", "IN005"],
    ["150140", "BelÃ©m", "PA", "80,5", "1.234,5", "x"],
    ["150140", "Belém", "PA", "90,5", None, None],
    [None, None, None, None, None, None],
    ["130260", "Manaus", "AM", "70", "1", None],
    ["150140", "Longe", "PA", "70", "1", None],
]


def cells_frame(spark, rows):
    return spark.createDataFrame(rows, "file string, sheet string, row int, col int, text string")


def test_sheet_layout_and_records(spark):
    no_header = [["a", "b"], ["1", "2"]]
    no_codes = [["Código IBGE", "Município"], ["1500800", "Ananindeua"]]
    cells = cells_frame(
        spark,
        sheet_cells("d/AE2020/LEP.xls", "s", WATER_SHEET)
        + sheet_cells("d/AE2020/LEP.xls", "vazia", no_header)
        + sheet_cells("d/AE2021/LPR.xls", "s", no_codes),
    )
    fixed = repaired_cells(cells)
    assert {(r.file[2:8], r.sheet): r.header_row for r in header_rows(fixed).collect()} == {("AE2020", "s"): 1, ("AE2021", "s"): 0}
    layout = sheet_layout(fixed)
    assert {r.file[2:8]: (r.code_row, r.data_row) for r in layout.collect()} == {"AE2020": (2, 3), "AE2021": (None, 1)}
    names = [r.name for r in column_names(fixed, layout).filter("file LIKE '%LEP%'").orderBy("col").collect()]
    assert names == ["Código do Município", "Município", "UF", "Índice de atendimento total de água (%)", "Tarifa", "Tarifa_1"]
    records = sheet_records(cells).orderBy("file", "row").collect()
    assert [(r.municipio, r.uf, r.idx_atend_agua_total) for r in records] == [
        ("Belém", "PA", "80,5"), ("Belém", "PA", "90,5"), ("Manaus", "AM", "70"), ("Longe", "PA", "70"), ("Ananindeua", None, None)
    ]
    assert [r.has_uf for r in records] == [True] * 4 + [False]


def test_touched_partitions_only(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([(1, 2019, 1), (2, 2019, 2), (3, 2020, 1)], "v int, ano int, mes int")
    replace_touched_partitions(first, path, ["ano", "mes"])
    replace_touched_partitions(spark.createDataFrame([(9, 2019, 2)], first.schema), path, ["ano", "mes"])
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [1, 3, 9]
    replace_table(spark.createDataFrame([(5, 2021, 1)], first.schema), path, ["ano", "mes"])
    assert [r.v for r in spark.read.parquet(path).collect()] == [5]


def test_csv_twin_and_stamp(spark, tmp_path):
    table = spark.createDataFrame([(1, 0.5, "é"), (2, None, "b")], "i int, x double, t string")
    replace_with_csv_twin(table, str(tmp_path / "p"), str(tmp_path / "c"))
    twin = spark.read.schema(table.schema).option("header", True).csv(str(tmp_path / "c"))
    assert sorted(map(tuple, twin.collect())) == sorted(map(tuple, spark.read.parquet(str(tmp_path / "p")).collect()))
    now = generation_time()
    export_csv(stamped(table, now), str(tmp_path / "s"))
    stamps = spark.read.option("header", True).csv(str(tmp_path / "s")).select("gerado_em").distinct().collect()
    assert [r.gerado_em for r in stamps] == [now] and datetime.datetime.fromisoformat(now).tzinfo is not None


def test_decimal_comma_in_plan_is_pushed_as_columns(spark):
    rows = spark.createDataFrame([("1,5",)], "t string").select(decimal_comma(F.col("t")).alias("v"))
    assert "Python" not in rows._jdf.queryExecution().executedPlan().toString() and rows.first().v == 1.5
