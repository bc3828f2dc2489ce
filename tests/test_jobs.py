"""The whole chain from raw files to exports, on small generated files."""

import random

import pandas as pd
import pytest

from igarape import jobs
from igarape.__main__ import parser
from igarape.constants import SCORE_WEIGHTS, STATION_MUNICIPALITIES
from igarape.models.estimators import forest, lasso, linear
from igarape.plans.finance import finance_silver, read_finance_indicators
from tests.conftest import MUNICIPALITIES
from tests.test_sources import sheet_cells, water_text

CODES = [line.split(",")[1] for line in MUNICIPALITIES.split("\n")[1:9]]
YEARS = range(2018, 2026)


def write_admissions(folder):
    rng = random.Random(1)
    folder.mkdir(parents=True)
    rows = []
    for year in YEARS:
        lines = ["ANO_CMPT,MES_CMPT,MUNIC_RES,DIAG_PRINC,DIAS_PERM,VAL_TOT,EXTRA"]
        for i in range(300):
            code = rng.choice(CODES[:7])
            diagnosis = rng.choice(["A09", "a09.0", "E86", "J18", "A10", "E860", ""])
            days, value = rng.choice(["1", "2", "x", ""]), rng.choice(["10.5", "100", "ruim"])
            raw = rng.choice([code, code[:6]])
            lines.append(f"{year},{rng.randint(1, 2)},{raw},{diagnosis},{days},{value},q")
            rows.append((code, year, diagnosis, days, value))
        lines.append(f"{year},1,999999,A09,1,1,q")
        lines.append(f",1,{CODES[0]},A09,1,1,q")
        (folder / f"RDPA{year % 100}01.csv").write_text("\n".join(lines) + "\n")
    return pd.DataFrame(rows, columns=["cod", "ano", "diag", "dias", "valor"])


def write_water(folder):
    rng = random.Random(2)
    folder.mkdir(parents=True)
    rows = []
    for code in CODES:
        for year in YEARS:
            for parameter, good, bad in [
                ("Turbidez (uT)", "<= 5,0", "> 6,0"),
                ("Coliformes totais", "Ausência", "Presença"),
                ("pH", ">= 6,0 e <= 9,5", "> 10,0"),
            ]:
                base = {"Código IBGE": code, "Ano de referência": str(year), "Parâmetro": parameter}
                rows.append({**base, "Campo": good, "Valor": str(rng.randint(50, 90))})
                rows.append({**base, "Campo": bad, "Valor": str(rng.randint(1, 20))})
    (folder / "controle_basicos.csv").write_bytes(water_text(rows))


def write_stations(folder):
    rng = random.Random(3)
    header = "DATA (YYYY-MM-DD);HORA (UTC);PRECIPITACAO TOTAL, HORARIO (MM);TEMPERATURA DO AR - BULBO SECO, HORARIA (°C);"
    for station in ("A201", "A202", "A227", "A999"):
        for year in YEARS:
            path = folder / str(year)
            path.mkdir(parents=True, exist_ok=True)
            lines = ["X:;Y"] * 8 + [header]
            for day in range(1, 11):
                for hour in ("00:00", "12:00"):
                    lines.append(f"{year}-01-{day:02d};{hour};{rng.randint(0, 90)},5;{rng.randint(24, 35)},0;")
            (path / f"INMET_N_PA_{station}_X_{year}.CSV").write_bytes(("\n".join(lines) + "\n").encode("latin-1"))


def write_finance(path):
    rng = random.Random(4)
    lines = ["cod_mun,ano,periodo,numero_indicador,ds_indicador,numerador,denominador,valor"]
    for code in CODES:
        for year in YEARS:
            for number in ("1.3", "1.6", "2.1", "2.2", "2.3", "2.4", "2.5", "2.6", "3.1", "3.2", "9.9"):
                bottom = "0" if (year == 2019 and number == "3.2") else "1000"
                lines.append(f"{code[:6]},{year},2,{number},texto,{rng.randint(1, 900)}.25,{bottom},1")
    path.parent.mkdir(parents=True)
    path.write_text("\n".join(lines) + "\n")


def write_population(folder):
    folder.mkdir(parents=True)
    header = "municipio_codigo,municipio_nome,ano,variavel_codigo,variavel_nome,unidade_codigo,unidade_nome,valor"
    for year in YEARS:
        lines = [header]
        if year != 2022:
            lines += [f"{c},x,{year},1,v,2,u,{10000 + 100 * i + year}" for i, c in enumerate(CODES)]
        (folder / f"sidra6579_pop_{year}.csv").write_text("\n".join(lines) + "\n")


def write_sheets(spark, path):
    rng = random.Random(5)
    cells = []
    names = [line.split(",")[0] for line in MUNICIPALITIES.split("\n")[1:7]]
    header = ["Código do Município", "Município", "UF", "Índice de atendimento total de água", "Índice de tratamento de esgoto",
              "Índice de coleta de esgoto", "Índice de perdas na distribuição", "Índice bruto de perdas lineares"]
    for year in range(2018, 2024):
        rows = [["Título"], header]
        for i, name in enumerate(names):
            for _ in range(2):
                figures = [f"{rng.randint(10, 99)},5" for _ in range(4)]
                rows.append([CODES[i][:6], name.upper(), "PA", *figures, "120000"])
        cells += sheet_cells(f"bronze/AE{year}/Planilha.xls", "s", rows)
    spark.createDataFrame(cells, "file string, sheet string, row int, col int, text string").write.parquet(str(path))


@pytest.fixture(scope="module")
def chain(spark, tmp_path_factory):
    """Run every job once; returns the folder and the raw admissions."""
    root = tmp_path_factory.mktemp("chain")
    municipalities = root / "municipalities.csv"
    municipalities.write_text(MUNICIPALITIES, encoding="utf-8")
    m = str(municipalities)
    raw = write_admissions(root / "bronze/sih")
    write_water(root / "bronze/sisagua")
    write_stations(root / "bronze/inmet")
    write_finance(root / "bronze/siops/indicators.csv")
    write_population(root / "bronze/ibge")
    write_sheets(spark, root / "cells.parquet")
    silver = f"{root}/silver"
    jobs.run_admissions(spark, f"{root}/bronze/sih", m, f"{silver}/sih")
    jobs.run_water_quality(spark, f"{root}/bronze/sisagua", m, f"{silver}/sisagua")
    jobs.run_climate(spark, f"{root}/bronze/inmet", f"{silver}/inmet")
    jobs.run_finance(spark, f"{root}/bronze/siops/indicators.csv", m, f"{silver}/siops")
    jobs.run_population(spark, f"{root}/bronze/ibge", f"{silver}/ibge_populacao")
    jobs.run_service_indicators(spark, f"{root}/cells.parquet", m, f"{root}/service")
    jobs.run_gold(spark, silver, f"{root}/service/v2.parquet", m, f"{root}/gold.parquet", f"{root}/gold.csv")
    jobs.run_analysis(spark, f"{root}/gold.parquet", m, f"{root}/out", f"{root}/service/v2.parquet")
    models = {"LinearRegression": linear(), "Lasso": lasso(), "RandomForest": forest(10, depth=5)}
    jobs.run_models(spark, f"{root}/out/analysis.parquet", f"{root}/out", models=models, repeats=3)
    return root, raw


def table(spark, path):
    return spark.read.parquet(str(path)).toPandas()


def export(spark, path):
    return spark.read.option("header", True).option("inferSchema", True).csv(str(path)).toPandas()


def test_admissions_totals(spark, chain):
    root, raw = chain
    silver = table(spark, root / "silver/sih")
    raw["hidrica"] = raw.diag.str.upper().str.replace(".", "").str.match("A0[0-9]|E86")
    raw["v"] = pd.to_numeric(raw.valor, errors="coerce").fillna(0)
    raw["d"] = pd.to_numeric(raw.dias, errors="coerce").fillna(0)
    assert silver.internacoes_total.sum() == len(raw) and silver.internacoes_hidricas.sum() == raw.hidrica.sum()
    assert silver.valor_hidricas.sum() == raw[raw.hidrica].v.sum() and silver.dias_perm_total.sum() == raw.d.sum()
    assert not silver.duplicated(["cod_mun", "ano", "mes"]).any()
    assert "SANTA BARBARA DO PARA" in set(silver.municipio)


def test_gold_grid_and_scales(spark, chain):
    root, raw = chain
    gold = table(spark, root / "gold.parquet")
    assert len(gold) == 64 and not gold.duplicated(["cod_mun", "ano"]).any()
    assert set(gold.cod_mun) == set(CODES) and set(gold.ano) == set(YEARS)
    percents = gold[[c for c in gold.columns if c.startswith(("pct_conformes", "idx_atend"))]]
    assert percents.min().min() >= 0 and percents.max().max() <= 100
    # Population of 2022 came without rows, so its rates are unknown.
    assert gold[gold.ano == 2022].internacoes_total_10k.isna().all()
    one = gold[(gold.cod_mun == CODES[0]) & (gold.ano == 2020)].iloc[0]
    expected = ((raw.cod == CODES[0]) & (raw.ano == 2020)).sum()
    assert one.internacoes_total == expected
    assert one.internacoes_total_10k == pytest.approx(expected / 12020 * 10000)
    assert one.idx_perdas_lineares == 1200.0
    assert len(export(spark, root / "gold.csv")) == 64


def test_climate_reaches_all_municipalities(spark, chain):
    root, _ = chain
    gold = table(spark, root / "gold.parquet").set_index(["cod_mun", "ano"])
    hours = table(spark, root / "silver/inmet")
    for station, code in STATION_MUNICIPALITIES:
        own = hours[(hours.estacao == station) & (hours.ano == 2021)]
        days = own.groupby(own.timestamp_utc.dt.date).temp_c.max()
        row = gold.loc[(code, 2021)]
        assert row.chuva_total_mm == pytest.approx(own.chuva_mm.sum())
        assert row.temp_media_c == pytest.approx(own.temp_c.mean())
        assert row.dias_calor_extremo == (days >= 32).sum()


def test_finance_ratios(spark, chain):
    root, _ = chain
    silver = table(spark, root / "silver/siops").set_index(["cod_mun", "ano"])
    assert silver.loc[(CODES[0], 2019)].isna().pct_receita_propria_asps
    raw = pd.read_csv(root / "bronze/siops/indicators.csv")
    one = raw[(raw.cod_mun == int(CODES[2][:6])) & (raw.ano == 2020) & (raw.numero_indicador == 2.1)].iloc[0]
    assert silver.loc[(CODES[2], 2020)].despesa_saude_pc == round(one.numerador / 1000, 2)


def test_finance_rejects_unknown_codes(spark, dimension, tmp_path):
    path = tmp_path / "f.csv"
    path.write_text("cod_mun,ano,periodo,numero_indicador,numerador,denominador\n777777,2020,2,2.1,1,2\n")
    with pytest.raises(ValueError, match="777777"):
        finance_silver(read_finance_indicators(spark, str(path)), dimension)


def test_best_provider_is_kept(spark, chain):
    root, _ = chain
    raw, first = table(spark, root / "service/raw.parquet"), table(spark, root / "service/v1.parquet")
    assert len(first) == 36 and not first.duplicated(["cod_mun", "ano"]).any()
    assert set(first.fonte_planilha) == {"Planilha"} and raw.ano.nunique() == 6
    second = table(spark, root / "service/v2.parquet")
    assert set(second.cod_mun) == set(CODES[:6]) and (second.idx_perdas_lineares == 1200.0).all()


def test_analysis_matches_pandas(spark, chain):
    root, _ = chain
    panel = export(spark, root / "out/priority_panel.csv")
    assert len(panel) == 64
    score = 0
    for column, weight in SCORE_WEIGHTS.items():
        values = panel[column]
        spread = values.max() - values.min()
        score = score + weight * (0 if spread <= 1e-8 else (values - values.min()) / spread)
    assert (panel.score_priorizacao - score).abs().max() < 1e-12
    bins = pd.cut(score, [-9, 0.33, 0.66, 9], labels=["Estável", "Atenção", "Crítico"])
    assert (bins.astype(str) == panel.prioridade_categoria).all()
    # Two municipalities have no service figures at all: they take the median of the filled column.
    gold = table(spark, root / "gold.parquet").sort_values(["cod_mun", "ano"])
    filled = gold.groupby("cod_mun").idx_atend_agua_total.transform(lambda s: s.fillna(s.median()))
    filled = filled.fillna(filled.median())
    merged = panel.sort_values(["cod_mun", "ano"]).idx_atend_agua_total
    assert abs(merged.to_numpy() - filled.to_numpy()).max() < 1e-12
    analysis = table(spark, root / "out/analysis.parquet").sort_values(["cod_mun", "ano"])
    lagged = analysis.groupby("cod_mun").chuva_total_mm.shift(1)
    assert ((lagged == analysis.chuva_total_mm_lag1) | (lagged.isna() & analysis.chuva_total_mm_lag1.isna())).all()


def test_goals_tracker(spark, chain):
    root, _ = chain
    goals = export(spark, root / "out/goals_tracker.csv")
    panel = export(spark, root / "out/priority_panel.csv")
    assert list(goals.ano) == list(YEARS)
    means = panel.groupby("ano").idx_tratamento_esgoto.mean()
    assert (goals.set_index("ano").idx_tratamento_esgoto_media - means).abs().max() < 1e-9
    status = goals.idx_tratamento_esgoto_media.ge(80).map({True: "OK", False: "Alerta"})
    assert (status == goals.status_idx_tratamento_esgoto_media).all()
    assert goals.gerado_em.nunique() == 1


def test_other_products(spark, chain):
    root, _ = chain
    coverage = export(spark, root / "out/coverage_by_year.csv")
    assert list(coverage.ano) == list(YEARS) and (coverage.percentual_cobertura == 1.0).all()
    assert spark.read.option("header", True).csv(f"{root}/out/missing_pairs.csv").count() == 0
    analysis = table(spark, root / "out/analysis.parquet")
    drivers = export(spark, root / "out/driver_correlations.csv").set_index("indicador").correlacao_com_taxa
    assert drivers["chuva_total_mm"] == pytest.approx(analysis.chuva_total_mm.corr(analysis.internacoes_hidricas_10k))
    assert list(drivers.abs()) == sorted(drivers.abs(), reverse=True)
    lag = export(spark, root / "out/lag_correlation.csv").correlacao_chuva_lag1[0]
    assert lag == pytest.approx(analysis.chuva_total_mm_lag1.corr(analysis.internacoes_hidricas_10k))
    ranking = export(spark, root / "out/latest_ranking.csv")
    assert set(ranking.ano) == {2025} and ranking.score_priorizacao.is_monotonic_decreasing and len(ranking) == 8
    returns = export(spark, root / "out/group_return.csv").set_index("municipio")
    one = analysis[analysis.municipio == "BARCARENA"]
    expected = one.pct_despesa_investimentos_saude.corr(one.internacoes_hidricas_10k)
    found = returns.loc["BARCARENA"].elasticidade_inv_taxa
    assert (pd.isna(found) and pd.isna(expected)) or found == pytest.approx(expected)


def test_missing_pairs(spark, chain, dimension):
    from igarape.plans.analysis import missing_pairs

    root, _ = chain
    gold = spark.read.parquet(str(root / "gold.parquet")).filter("NOT (ano = 2020 AND municipio LIKE 'B%')")
    found = [(r.municipio, r.ano) for r in missing_pairs(gold, dimension).collect()]
    assert found == [("BARCARENA", 2020), ("BELÉM", 2020), ("BENEVIDES", 2020)]


def test_model_exports(spark, chain):
    root, _ = chain
    metrics = export(spark, root / "out/model_metrics.csv")
    assert sorted(metrics.dataset) == ["GroupKFold"] * 3 + ["Holdout_2025"]
    best = metrics[metrics.dataset == "GroupKFold"].sort_values("mae").iloc[0].model
    assert metrics[metrics.dataset == "Holdout_2025"].iloc[0].model == best
    predictions = export(spark, root / "out/model_predictions.csv")
    assert len(predictions) == 64
    gap = (predictions.taxa_prevista - predictions.taxa_observada).abs() - predictions.erro_absoluto
    assert gap.abs().max() < 1e-9
    importances = export(spark, root / "out/model_importances.csv")
    assert set(importances.tipo) == {"model_importance", "permutation_importance"}
    assert importances.groupby("tipo").size().nunique() == 1
    errors = export(spark, root / "out/model_holdout_errors.csv")
    by_name = export(spark, root / "out/model_municipality_errors.csv").set_index("municipio")
    assert len(errors) == 8
    assert (errors.set_index("municipio").erro_absoluto - by_name.mae).abs().max() < 1e-9
    scenarios = export(spark, root / "out/model_scenarios.csv")
    assert len(scenarios) == 6
    assert (scenarios.impacto_min_taxa <= scenarios.impacto_medio_taxa + 1e-12).all()
    assert (scenarios.impacto_medio_taxa <= scenarios.impacto_max_taxa + 1e-12).all()


def test_semicolon_admissions_have_a_decimal_comma(spark, tmp_path):
    (tmp_path / "m.csv").write_text(MUNICIPALITIES, encoding="utf-8")
    (tmp_path / "RDPA2001.csv").write_text(
        "ANO_CMPT;MES_CMPT;MUNIC_RES;DIAG_PRINC;DIAS_PERM;VAL_TOT\n2020;1;150140;A09;2;1234,5\n2020;1;130260;A09;2;9\n"
    )
    jobs.run_admissions(spark, str(tmp_path), str(tmp_path / "m.csv"), str(tmp_path / "out"), ";")
    row = spark.read.parquet(str(tmp_path / "out")).first()
    assert (row.cod_mun, row.valor_hidricas, row.dias_perm_total) == ("1501402", 1234.5, 2.0)


def test_no_matching_admission_is_an_error(spark, tmp_path):
    (tmp_path / "m.csv").write_text(MUNICIPALITIES, encoding="utf-8")
    (tmp_path / "RDPA2001.csv").write_text("ANO_CMPT,MES_CMPT,MUNIC_RES,DIAG_PRINC,DIAS_PERM,VAL_TOT\n2020,1,1,A,1,1\n")
    with pytest.raises(ValueError, match="no rows"):
        jobs.run_admissions(spark, str(tmp_path), str(tmp_path / "m.csv"), str(tmp_path / "out"))


def test_member_share(spark, dimension):
    from igarape.plans.admissions import member_share

    raw = spark.createDataFrame([("150140",), ("1501402",), ("130260",), (None,)], "MUNIC_RES string")
    assert member_share(raw, dimension).first().asDict() == {"registros": 4, "registros_membros": 2, "pct_membros": 50.0}


def test_municipality_list(spark, chain):
    root, _ = chain
    found = jobs.municipality_list(f"{root}/silver/ibge_populacao", f"{root}/municipalities.csv", spark).collect()
    assert [r.cod_mun for r in found] == sorted(CODES) and found[0].municipio == "ANANINDEUA"


def test_command_line_options():
    args = parser().parse_args(["admissions", "--csv-dir", "a", "--municipios", "b", "--out-dir", "c", "--chunksize", "5"])
    assert (args.job, args.csv_dir, args.municipios, args.out_dir) == ("admissions", "a", "b", "c")
    assert parser().parse_args(["gold", "--out-parquet", "x"]).out_parquet == "x"
    assert parser().parse_args(["modelling", "--holdout-year", "2024"]).holdout_year == 2024
