"""Fixed values shared by the jobs.

Everything here is data, not logic: names, codes, limits and patterns that the
results depend on.
"""

# --- fixed values: admissions ------------------------------------------------
# Diagnosis prefixes counted as waterborne: A00..A09 and dehydration.
WATERBORNE_PREFIXES = [
    "A00", "A01", "A02", "A03", "A04", "A05", "A06", "A07", "A08", "A09", "E86",
]

ADMISSION_MEASURES = [
    "internacoes_total",
    "internacoes_hidricas",
    "dias_perm_total",
    "dias_perm_hidricas",
    "valor_total",
    "valor_hidricas",
]

# --- fixed values: water quality ---------------------------------------------
PARAMETER_ALIASES = {
    "cloro_residual_livre_mg_l": "cloro_residual_livre",
    "cloro_residual_livre": "cloro_residual_livre",
    "turbidez_ut": "turbidez",
    "turbidez": "turbidez",
    "cor_uh": "cor",
    "cor": "cor",
    "ph": "ph",
    "coliformes_totais": "coliformes_totais",
    "escherichia_coli": "escherichia_coli",
    "fluoreto_mg_l": "fluoreto",
    "fluoreto": "fluoreto",
}

# Legal upper limits and the accepted pH range.
UPPER_LIMITS = {"turbidez": 5.0, "cor": 15.0, "fluoreto": 1.5}
PH_RANGE = (6.0, 9.5)

MICROBIAL_PARAMETERS = ["coliformes_totais", "escherichia_coli"]

# Parameters that get their own gold column.
QUALITY_PARAMETERS = [
    "cloro_residual_livre",
    "turbidez",
    "ph",
    "coliformes_totais",
    "escherichia_coli",
    "fluoreto",
    "cor",
]
PERCENTILE_PARAMETERS = ["turbidez", "cloro_residual_livre", "ph", "fluoreto"]

# Water-quality file headers -> column names used here.
WATER_HEADERS = {
    "uf": "UF",
    "codigo": "Código IBGE",
    "municipio_sisagua": "Município",
    "ano_ref": "Ano de referência",
    "mes_ref": "Mês de referência",
    "parametro_texto": "Parâmetro",
    "campo": "Campo",
    "valor_texto": "Valor",
    "ponto_monitoramento": "Ponto de Monitoramento",
    "forma_abastecimento_tipo": "Tipo da Forma de Abastecimento",
    "forma_abastecimento_nome": "Nome da Forma de Abastecimento",
    "forma_abastecimento_codigo": "Código Forma de abastecimento",
    "eta_uta_nome": "Nome da ETA / UTA",
    "instituicao_sigla": "Sigla da Instituição",
    "instituicao_nome": "Nome da Instituição",
}

# --- fixed values: climate ---------------------------------------------------
# Standard column -> header texts seen over the years.
STATION_HEADERS = {
    "data": ["data", "data (yyyy-mm-dd)"],
    "hora_utc": ["hora utc", "hora (utc)"],
    "chuva_mm": [
        "precipitacao total, horario (mm)",
        "precipitacao total horaria (mm)",
    ],
    "pressao_atm_mb": ["pressao atmosferica ao nivel da estacao, horaria (mb)"],
    "radiacao_global_kj_m2": ["radiacao global (kj/m²)", "radiacao global"],
    "temp_c": [
        "temperatura do ar - bulbo seco, horaria (°c)",
        "temperatura do ar - bulbo seco, horaria (c)",
    ],
    "umid_rel_pct": ["umidade relativa do ar, horaria (%)"],
    "vento_dir_graus": [
        "vento, direcao horaria (gr) (° (gr))",
        "vento, direcao horaria (gr)",
    ],
    "vento_rajada_ms": ["vento, rajada maxima (m/s)"],
    "vento_vel_ms": ["vento, velocidade horaria (m/s)"],
}

STATION_MEASURES = [
    "chuva_mm",
    "temp_c",
    "umid_rel_pct",
    "vento_vel_ms",
    "vento_dir_graus",
    "vento_rajada_ms",
    "pressao_atm_mb",
    "radiacao_global_kj_m2",
]

STATION_MISSING = ["-9999", "-9999.0", ""]
STATION_PREAMBLE_LINES = 8
HEAT_THRESHOLD_C = 32.0

# Station -> municipalities it stands for.
STATION_MUNICIPALITIES = [
    ("A201", "1501402"),
    ("A201", "1500800"),
    ("A201", "1504422"),
    ("A201", "1501501"),
    ("A202", "1502400"),
    ("A202", "1506500"),
    ("A202", "1506351"),
    ("A227", "1501303"),
]

# --- fixed values: health finance --------------------------------------------
# Indicator code -> (column, scale); scale 100 makes a percentage.
FINANCE_INDICATORS = {
    "1.3": ("pct_transferencias_sus_recursos", 100.0),
    "1.6": ("pct_receita_impostos_transf", 100.0),
    "2.1": ("despesa_saude_pc", 1.0),
    "2.2": ("pct_despesa_pessoal_saude", 100.0),
    "2.3": ("pct_despesa_medicamentos_saude", 100.0),
    "2.4": ("pct_despesa_terceiros_pj_saude", 100.0),
    "2.5": ("pct_despesa_investimentos_saude", 100.0),
    "2.6": ("pct_despesa_privado_sem_fins", 100.0),
    "3.1": ("pct_transferencias_sobre_despesa", 100.0),
    "3.2": ("pct_receita_propria_asps", 100.0),
}

# Columns kept from the sub-function payload.
SUBFUNCTION_COLUMNS = [
    "quadro", "grupo", "ordem", "descricao",
    "valor1", "valor2", "valor3", "valor4", "valor5",
    "valor6", "valor7", "valor8", "valor9", "valor10",
]

# --- fixed values: service indicators ----------------------------------------
SHEET_HEADER_SEARCH_ROWS = 30
SHEET_CODE_SEARCH_ROWS = 5
SHEET_CODE_LABELS = ["codigo_do_municipio", "codigo_ibge", "cod_ibge"]
SHEET_CODE_PATTERN = "(in|ia[g|e])[0-9]{3}"

# Key column -> accepted labels, in order of preference.
SHEET_KEY_ALIASES = {
    "cod_mun": [
        "codigo_do_municipio",
        "codigo_municipio",
        "codigo_ibge",
        "cod_ibge",
        "codigo_do_ibge",
    ],
    "municipio": ["municipio"],
    "uf": ["uf", "sigla_da_uf"],
}

# Indicator column -> label fragments.
SERVICE_INDICATORS = {
    "idx_atend_agua_total": [
        "indice_de_atendimento_total_de_agua",
        "atendimento_da_populacao_total_com_rede_de_abastecimento_de_agua",
    ],
    "idx_atend_agua_urbano": [
        "indice_de_atendimento_urbano_de_agua",
        "atendimento_da_populacao_urbana_com_rede_de_abastecimento_de_agua",
    ],
    "idx_coleta_esgoto": [
        "indice_de_coleta_de_esgoto",
        "atendimento_da_populacao_total_com_rede_coletora_de_esgotos",
    ],
    "idx_tratamento_esgoto": [
        "indice_de_tratamento_de_esgoto",
        "tratamento_do_volume_total_de_esgoto_coletado",
    ],
    "idx_esgoto_tratado_ref_agua": [
        "indice_de_esgoto_tratado_referido_a_agua_consumida",
    ],
    "idx_hidrometracao": ["indice_de_hidrometracao"],
    "idx_perdas_distribuicao": ["indice_de_perdas_na_distribuicao"],
    "idx_perdas_lineares": ["indice_bruto_de_perdas_lineares"],
    "idx_perdas_por_ligacao": ["indice_de_perdas_por_ligacao"],
    "tarifa_media_praticada": ["tarifa_media_praticada"],
    "tarifa_media_agua": ["tarifa_media_de_agua"],
    "tarifa_media_esgoto": ["tarifa_media_de_esgoto"],
    "despesa_total_m3": [
        "despesa_total_com_os_servicos_por_m3_faturado",
        "despesa_total_por_m3",
    ],
    "despesa_exploracao_m3": ["despesa_de_exploracao_por_m3_faturado"],
}

# Indicators whose sum decides which provider row is kept.
PROVIDER_SCORE_COLUMNS = [
    "idx_atend_agua_total",
    "idx_coleta_esgoto",
    "idx_tratamento_esgoto",
]

# Columns divided by 100 above the limit.
PERCENT_REPAIR_LIMIT = 100.0
PERCENT_REPAIR_COLUMNS = [
    "idx_atend_agua_total",
    "idx_atend_agua_urbano",
    "idx_coleta_esgoto",
    "idx_tratamento_esgoto",
    "idx_esgoto_tratado_ref_agua",
    "idx_hidrometracao",
    "idx_perdas_distribuicao",
]
PHYSICAL_REPAIR_LIMIT = 1000.0
PHYSICAL_REPAIR_COLUMNS = ["idx_perdas_lineares", "idx_perdas_por_ligacao"]

# Service columns carried into the gold table.
GOLD_SERVICE_COLUMNS = [
    "idx_atend_agua_total",
    "idx_atend_agua_urbano",
    "idx_coleta_esgoto",
    "idx_tratamento_esgoto",
    "idx_hidrometracao",
    "idx_perdas_distribuicao",
    "idx_perdas_lineares",
    "idx_perdas_por_ligacao",
    "tarifa_media_agua",
    "tarifa_media_esgoto",
]

# --- fixed values: analysis --------------------------------------------------
FALLBACK_COLUMNS = [
    "idx_atend_agua_total",
    "idx_atend_agua_urbano",
    "idx_coleta_esgoto",
    "idx_tratamento_esgoto",
    "idx_hidrometracao",
    "idx_perdas_distribuicao",
    "idx_perdas_lineares",
    "idx_perdas_por_ligacao",
    "tarifa_media_agua",
]

IMPUTED_COLUMNS = [
    "idx_atend_agua_total",
    "idx_tratamento_esgoto",
    "idx_coleta_esgoto",
    "idx_perdas_distribuicao",
    "pct_conformes_global",
    "despesa_saude_pc",
    "pct_despesa_investimentos_saude",
    "chuva_total_mm",
    "temp_media_c",
    "populacao",
    "internacoes_hidricas_10k",
    "internacoes_total_10k",
]

CLIPPED_PERCENT_COLUMNS = [
    "idx_atend_agua_total",
    "idx_tratamento_esgoto",
    "idx_coleta_esgoto",
    "pct_conformes_global",
]

SCORE_WEIGHTS = {
    "internacoes_hidricas_10k": 0.40,
    "deficit_tratamento": 0.20,
    "alerta_qualidade": 0.15,
    "deficit_atendimento": 0.15,
    "perdas_excesso": 0.10,
}

# Right-closed upper edges; the last label is open-ended.
PRIORITY_EDGES = [0.33, 0.66]
PRIORITY_LABELS = ["Estável", "Atenção", "Crítico"]

DRIVER_COLUMNS = [
    "idx_atend_agua_total",
    "idx_tratamento_esgoto",
    "idx_coleta_esgoto",
    "idx_perdas_distribuicao",
    "pct_conformes_global",
    "chuva_total_mm",
    "despesa_saude_pc",
    "pct_despesa_investimentos_saude",
]

RANKING_COLUMNS = [
    "municipio",
    "ano",
    "internacoes_hidricas_10k",
    "idx_atend_agua_total",
    "idx_tratamento_esgoto",
    "pct_conformes_global",
    "perdas_excesso",
    "score_priorizacao",
    "prioridade_categoria",
]

PRIORITY_PANEL_COLUMNS = [
    "cod_mun",
    "municipio",
    "ano",
    "populacao",
    "internacoes_hidricas",
    "internacoes_hidricas_10k",
    "internacoes_total_10k",
    "idx_atend_agua_total",
    "idx_tratamento_esgoto",
    "idx_coleta_esgoto",
    "pct_conformes_global",
    "idx_perdas_distribuicao",
    "despesa_saude_pc",
    "pct_despesa_investimentos_saude",
    "chuva_total_mm",
    "temp_media_c",
    "deficit_atendimento",
    "deficit_tratamento",
    "alerta_qualidade",
    "perdas_excesso",
    "score_priorizacao",
    "prioridade_categoria",
]

# Goal column -> (kind, goal).
GOALS = {
    "taxa_hidricas_10k_rmb": ("max", 30.0),
    "pct_conformes_global_media": ("min", 95.0),
    "idx_atend_agua_total_media": ("min", 95.0),
    "idx_tratamento_esgoto_media": ("min", 80.0),
}
EXPECTED_YEARS = (2018, 2025)

# --- fixed values: modelling -------------------------------------------------
TARGET = "internacoes_hidricas_10k"
FEATURE_CANDIDATES = [
    "idx_atend_agua_total",
    "idx_tratamento_esgoto",
    "idx_coleta_esgoto",
    "pct_conformes_global",
    "idx_perdas_distribuicao",
    "deficit_atendimento",
    "deficit_tratamento",
    "alerta_qualidade",
    "perdas_excesso",
    "chuva_total_mm",
    "chuva_total_mm_lag1",
    "temp_media_c",
    "umid_rel_media_pct",
    "despesa_saude_pc",
    "pct_despesa_investimentos_saude",
    "pct_despesa_medicamentos_saude",
    "pct_despesa_pessoal_saude",
    "pct_transferencias_sus_recursos",
    "pct_transferencias_sobre_despesa",
    "pct_receita_propria_asps",
    "populacao",
]
HOLDOUT_YEAR = 2025
MAX_FOLDS = 4
LASSO_ALPHA = 0.001
LASSO_ITERATIONS = 10000
FOREST_TREES = 600
FOREST_MIN_LEAF = 2
SEED = 42
PERMUTATION_REPEATS = 50

# What-if steps: (feature, delta).
SCENARIOS = [
    ("idx_atend_agua_total", 5.0),
    ("idx_tratamento_esgoto", 5.0),
    ("pct_conformes_global", 5.0),
    ("pct_despesa_investimentos_saude", 0.5),
    ("pct_receita_propria_asps", 0.5),
    ("pct_transferencias_sus_recursos", 0.5),
]
# Features with one of these name starts are kept within [0, 100].
PERCENT_NAME_STARTS = ["idx_", "pct_", "deficit", "alerta", "perdas"]
