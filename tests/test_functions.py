"""Column functions on values whose result is known."""

import datetime
import sys
import time

import pytest
from pyspark.sql import functions as F

from igarape.functions import classify, dates, numeric, text


def evaluate(spark, expression, values, type_="string"):
    rows = spark.createDataFrame([(v,) for v in values], f"v {type_}")
    return [r[0] for r in rows.select(expression(F.col("v"))).collect()]


@pytest.mark.parametrize(
    "function, value, expected",
    [
        (text.strip_accents, "São Félix ½ ﬁm №2 日本", "Sao Felix 1⁄2 fim No2 日本"),
        (text.strip_accents, "é plain", "e plain"),
        (text.strip_accents, "", ""),
        (text.strip_accents, None, None),
        (text.to_ascii, "Água (°C) ≤ 5 m²", "Agua (C)  5 m2"),
        (text.upper_ascii, "Santa Bárbara do Pará", "SANTA BARBARA DO PARA"),
        (text.operator_slug, "Cloro residual livre (mg/L)", "cloro_residual_livre_mg_l"),
        (text.operator_slug, ">= 0,2 e <= 5% = x<y>z", "gte_0_2_e_lte_5_pct_eq_x_lt_y_gt_z"),
        (text.label_slug, " Código do Município ", "codigo_do_municipio"),
        (text.compact_slug, "Vento, Direção  (gr)", "vento_direcao_gr"),
        (text.clean_label, "- IN055\n(%) -", "IN055 (%)"),
        (text.blank_to_null, "  ", None),
        (text.digits_only, "15.014-02/x", "1501402"),
        (text.padded_code, "15.014.02-9", "1501402"),
        (text.padded_code, "12", "000012"),
        (text.padded_code, None, "000000"),
        (text.padded_code_or_null, "sem", None),
        (text.padded_code_or_null, "150140", "150140"),
        (text.code_run, "cód. 12345 e 15014029", "1501402"),
        (text.code_run, "12345", None),
        (text.repair_mojibake, "MunicÃ\xadpio", "Município"),
        (text.repair_mojibake, "Município", "Município"),
        (text.repair_mojibake, "日本", "日本"),
        (text.diagnosis_code, " a09.0 ", "A090"),
        (text.diagnosis_code, None, ""),
        (text.normalise_signs, "≤ 5 e ≥ 2 ＜ ＞", "<= 5 e >= 2 < >"),
        (numeric.to_number, " 1.5e2 ", 150.0),
        (numeric.to_number, "5d", None),
        (numeric.to_number, "NaN", None),
        (numeric.to_whole, "2020.0", 2020),
        (numeric.to_whole, "x", None),
        (numeric.decimal_comma, "R$ 1.234,5", 1234.5),
        (numeric.decimal_comma, "1.5", 1.5),
        (numeric.decimal_comma, "-", None),
        (numeric.decimal_comma, "", None),
        (numeric.decimal_comma, "1.2.3", None),
        (numeric.decimal_comma_strict, "1.5", 15.0),
        (numeric.decimal_comma_strict, "1.234,5", 1234.5),
        (numeric.decimal_comma_strict, "Sem Informacao", None),
        (numeric.numbers_in_text, ">= 0,2 e <= 5.0 de 12", [0.2, 50.0, 12.0]),
        (dates.hour_text, "0900 UTC", "0900"),
        (dates.hour_text, "23:00", "2300"),
        (dates.hour_text, "0", "0000"),
    ],
)
def test_value(spark, function, value, expected):
    assert evaluate(spark, function, [value]) == [expected]


def test_zero_fill_never_cuts(spark):
    assert evaluate(spark, lambda c: text.zero_fill(c, 3), ["7", "12345678"]) == ["007", "12345678"]


def test_indicator_code(spark):
    assert evaluate(spark, text.indicator_code, [2.0, 1.3, 10.0], "double") == ["2", "1.3", "10"]


def test_ratios_and_clips(spark):
    ratio = lambda c: numeric.guarded_ratio(F.lit(3.0), c, 100.0)
    assert evaluate(spark, ratio, [4.0, 0.0, -1.0, None], "double") == [75.0, None, None, None]
    clip = lambda c: numeric.clip(c, 0.0, 100.0)
    assert evaluate(spark, clip, [-5.0, 50.0, 101.0, None], "double") == [0.0, 50.0, 100.0, None]
    repair = lambda c: numeric.repair_scale(c, 100.0)
    assert evaluate(spark, repair, [100.0, 9550.0, None], "double") == [100.0, 95.5, None]


def test_right_closed_bins(spark):
    bins = lambda c: numeric.right_closed_label(c, [0.33, 0.66], ["a", "b", "c"])
    assert evaluate(spark, bins, [0.33, 0.330001, 0.66, 0.7, None], "double") == ["a", "b", "b", "c", None]


def test_goal_status(spark):
    low = lambda c: numeric.goal_status(c, "max", 30.0)
    assert evaluate(spark, low, [30.0, 30.1, None], "double") == ["OK", "Alerta", "Sem dado"]


def test_station_timestamp(spark):
    rows = spark.createDataFrame(
        [("2020/01/31", "2300 UTC"), ("2020-01-31", "23:00"), ("2020-02-30", "0000"), ("x", "0000"), ("2020-01-01", "xx")],
        "d string, h string",
    )
    expected = datetime.datetime(2020, 1, 31, 23)
    found = [r[0] for r in rows.select(dates.station_timestamp("d", "h")).collect()]
    assert found == [expected, expected, None, None, None]


@pytest.mark.parametrize(
    "parameter, label, expected",
    [
        ("turbidez", "Número de amostras analisadas", "total"),
        ("coliformes_totais", "Ausência", "conforme"),
        ("escherichia_coli", "Presença", "nao_conforme"),
        ("escherichia_coli", "outro", "nao_classificado"),
        ("cloro_residual_livre", ">= 0,2 mg/L e <= 2,0 mg/L", "conforme"),
        ("cloro_residual_livre", ">2.0 e <=5.0", "nao_classificado"),
        ("cloro_residual_livre", "> 5,0", "nao_conforme"),
        ("cloro_residual_livre", "< 0,2", "nao_conforme"),
        ("turbidez", "<= 5,0 uT", "conforme"),
        ("turbidez", "≤ 1,0 uT", "conforme"),
        ("turbidez", "> 5,0", "nao_classificado"),
        ("turbidez", "> 6,0", "nao_conforme"),
        ("cor", "> 1,0 e <= 20,0", "nao_classificado"),
        ("fluoreto", "<= 1.5", "nao_classificado"),
        ("ph", ">= 6,0 e <= 9,5", "conforme"),
        ("ph", "< 6,0", "nao_classificado"),
        ("ph", "< 5,0", "nao_conforme"),
        ("ph", "> 10,0", "nao_conforme"),
        ("turbidez", "Percentil 95", "percentil_95"),
        ("nitrato", "Percentil 95", "percentil_95"),
        ("nitrato", "qualquer", "nao_classificado"),
    ],
)
def test_sample_class(spark, parameter, label, expected):
    rows = spark.createDataFrame([(parameter, label)], "p string, l string")
    assert rows.select(classify.sample_class("p", "l")).first()[0] == expected


def test_sample_class_options(spark):
    rows = spark.createDataFrame([("turbidez", "Percentil 95"), ("turbidez", "> 5,0"), ("ph", "> 9,5")], "p string, l string")
    late = [r[0] for r in rows.select(classify.sample_class("p", "l", percentile_first=False)).collect()]
    assert late == ["nao_classificado"] * 3
    inclusive = [r[0] for r in rows.select(classify.sample_class("p", "l", inclusive_bounds=True)).collect()]
    assert inclusive == ["percentil_95", "nao_conforme", "nao_conforme"]


def test_slugs_of_every_character(spark):
    points = spark.range(1, sys.maxunicode + 1).filter("id < 55296 OR id > 57343")
    chars = points.select(F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32").alias("c"))
    assert chars.filter(F.col("c").rlike(text._SEVERAL) != F.col("c").isin(list(text._FOLD_SEVERAL))).count() == 0
    v = F.concat(F.lit("A "), "c", F.lit("_b"))
    plain = F.regexp_replace(F.lower(text.to_ascii(v)), "[^a-z0-9_ ]", "")
    expected = F.btrim(F.regexp_replace(plain, " +", "_"), F.lit("_"))
    assert chars.filter(text.compact_slug(v) != expected).count() == 0


def test_a_compact_slug_takes_about_as_long_as_another(spark):
    rows = spark.range(0, 4000, 1, 4).select(F.concat(F.repeat(F.lit("Plain words, in a row; "), 400), F.col("id").cast("string")).alias("v"))
    rows = rows.localCheckpoint()
    taken = {}
    for _ in range(3):
        for slug in (text.label_slug, text.compact_slug):
            begin = time.perf_counter()
            rows.select(F.max(F.md5(slug("v")))).collect()
            taken[slug] = min(time.perf_counter() - begin, taken.get(slug, 1e9))
    assert taken[text.compact_slug] < 4 * taken[text.label_slug]
