"""Scans, projections, filters and searches in cells."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from igarape.functions.numeric import to_number, to_whole
from igarape.functions.text import contains_any, diagnosis_code, starts_with_any, upper_ascii
from igarape.operators.cells import column_per_role, first_matching_row, lines_after
from igarape.operators.lookup import either_key, keep_members, keep_members_unsummed
from igarape.operators.ordering import occurrence_number
from igarape.operators.reshape import harmonised, keys_first
from igarape.queries import facts
from igarape.queries.registry import query, table


@query(
    "dim_lookup_two_keys",
    f"""WITH {facts.DIM_SQL}
    SELECT cod_mun AS lookup_code, cod_mun, name FROM dim
    UNION ALL SELECT substr(cod_mun, 1, 6), cod_mun, name FROM dim""",
)
def dim_lookup_two_keys(spark: SparkSession, folder: str) -> DataFrame:
    return either_key(facts.nations(spark, folder)).select("lookup_code", "cod_mun", "name")


@query("scan_projection", "SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice FROM orders")
def scan_projection(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")


@query(
    "preamble_skip_lines",
    """SELECT doc_id, CAST(i - 1 AS INTEGER) AS line_no, lines[i] AS line
    FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents) d,
         unnest(range(3, len(d.lines) + 1)) AS t(i)""",
)
def preamble_skip_lines(spark: SparkSession, folder: str) -> DataFrame:
    return lines_after(table(spark, folder, "documents"), ["doc_id"], "text", skip=2)


@query(
    "filename_regex_label",
    """SELECT doc_id, regexp_extract(source, 'src(\\d+)', 1) AS numero,
         CASE WHEN CAST(regexp_extract(source, 'src(\\d+)', 1) AS INTEGER) > 9
              THEN 'demais_parametros' ELSE 'parametros_basicos' END AS dataset
    FROM documents""",
)
def filename_regex_label(spark: SparkSession, folder: str) -> DataFrame:
    number = F.regexp_extract("source", r"src(\d+)", 1)
    label = F.when(to_whole(number) > 9, "demais_parametros").otherwise("parametros_basicos")
    return table(spark, folder, "documents").select("doc_id", number.alias("numero"), label.alias("dataset"))


@query(
    "json_flatten",
    """SELECT event_type, count(*) AS n, CAST(sum(CAST(regexp_extract(props, '"k": *(\\d+)', 1) AS BIGINT)) AS BIGINT)
         AS k_total FROM events GROUP BY 1""",
)
def json_flatten(spark: SparkSession, folder: str) -> DataFrame:
    fields = F.from_json("props", "k bigint").alias("item")
    flat = table(spark, folder, "events").select("event_type", fields).select("event_type", "item.*")
    return flat.groupBy("event_type").agg(F.count("*").alias("n"), F.sum("k").alias("k_total"))


_PARTNER = {
    "codigo": ["s_suppkey", "c_custkey"],
    "nome": ["s_name", "c_name"],
    "nacao": ["s_nationkey", "c_nationkey"],
    "saldo": ["s_acctbal", "c_acctbal"],
    "segmento": ["c_mktsegment"],
    "telefone": ["s_phone", "c_phone"],
}
_PARTNER_TYPES = {
    "codigo": "long", "nome": "string", "nacao": "int", "saldo": "double", "segmento": "string", "telefone": "string",
}


@query(
    "header_alias_coalesce",
    """SELECT s_suppkey AS codigo, s_name AS nome, s_nationkey AS nacao, s_acctbal AS saldo,
         CAST(NULL AS VARCHAR) AS segmento, CAST(NULL AS VARCHAR) AS telefone FROM supplier
    UNION ALL SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, CAST(NULL AS VARCHAR) FROM customer""",
)
def header_alias_coalesce(spark: SparkSession, folder: str) -> DataFrame:
    parts = [harmonised(table(spark, folder, t), _PARTNER, _PARTNER_TYPES) for t in ("supplier", "customer")]
    return parts[0].unionByName(parts[1])


_ARTICLES = ["the", "der", "el", "le"]


@query(
    "grid_header_detect",
    """WITH lines AS (
      SELECT doc_id, i - 1 AS line_no, string_split(l[i], ' ') AS words, len(l) AS n_lines
      FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents) d, unnest(range(1, len(d.l) + 1)) AS t(i)),
    hits AS (
      SELECT doc_id, n_lines, min(line_no) AS header_row FROM lines
      WHERE line_no < 30
        AND len(list_filter(words, lambda w: w IN ('the', 'der', 'el', 'le'))) > 0
        AND len(list_filter(words, lambda w: contains(w, 'en'))) > 0
      GROUP BY 1, 2)
    SELECT doc_id, CAST(header_row AS INTEGER) AS header_row, n_lines - header_row - 1 AS rows_after FROM hits""",
)
def grid_header_detect(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select(
        "doc_id", "text", F.size(F.split("text", "\n", -1)).alias("height")
    )
    keys = ["doc_id", "height"]
    lines = lines_after(documents, keys, "text", skip=0)
    cells = lines.filter(F.col("line_no") < 30).select(
        *keys, "line_no", F.explode(F.split("line", " ", -1)).alias("word")
    )
    tests = [F.col("word").isin(_ARTICLES), F.contains("word", F.lit("en"))]
    headers = first_matching_row(cells, keys, "line_no", tests, "header_row")
    return headers.select(
        "doc_id", "header_row", (F.col("height") - F.col("header_row") - 1).cast("long").alias("rows_after")
    )


@query(
    "dedupe_names_cumcount",
    """SELECT p_partkey, CASE WHEN n > 0 THEN p_name || '_' || n ELSE p_name END AS nome, n AS repeticao
    FROM (SELECT p_partkey, p_name, row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) - 1 AS n FROM part)""",
)
def dedupe_names_cumcount(spark: SparkSession, folder: str) -> DataFrame:
    parts = table(spark, folder, "part").select("p_partkey", "p_name")
    numbered = occurrence_number(parts, ["p_name"], "p_partkey", "repeticao")
    name = F.when(
        F.col("repeticao") > 0, F.concat_ws("_", "p_name", F.col("repeticao").cast("string"))
    ).otherwise(F.col("p_name"))
    return numbered.select("p_partkey", name.alias("nome"), "repeticao")


_EXACT_LABELS = {"principal": ["red plate", "small widget", "hot ring"]}
_LABEL_PARTS = {"metal": ["bolt", "ring"], "placa": ["plate"], "outro": ["widget", "rod"]}


@query(
    "alias_pattern_match",
    """WITH roles(role, pattern, place) AS (VALUES
      ('principal', '^red plate$', 1), ('principal', '^small widget$', 2), ('principal', '^hot ring$', 3),
      ('metal', 'bolt|ring', 1), ('placa', 'plate', 1), ('outro', 'widget|rod', 1)),
    hits AS (
      SELECT p_brand, role, p_partkey,
             row_number() OVER (PARTITION BY p_brand, role ORDER BY place, p_partkey) AS r
      FROM part JOIN roles ON regexp_matches(p_name, pattern))
    SELECT p_brand, role, p_partkey FROM hits WHERE r = 1""",
)
def alias_pattern_match(spark: SparkSession, folder: str) -> DataFrame:
    parts = table(spark, folder, "part").select("p_brand", "p_partkey", "p_name")
    places = {
        r: F.array_position(F.array(*[F.lit(x) for x in labels]), F.col("p_name"))
        for r, labels in _EXACT_LABELS.items()
    }
    places |= {r: contains_any("p_name", pieces).cast("int") for r, pieces in _LABEL_PARTS.items()}
    return column_per_role(parts, ["p_brand"], "p_partkey", places)


@query(
    "project_reorder",
    "SELECT p_brand AS marca, p_type AS tipo, p_partkey AS codigo, p_name AS nome, p_size AS tamanho FROM part",
)
def project_reorder(spark: SparkSession, folder: str) -> DataFrame:
    renamed = table(spark, folder, "part").withColumnsRenamed(
        {"p_partkey": "codigo", "p_name": "nome", "p_brand": "marca", "p_type": "tipo", "p_size": "tamanho"}
    )
    return keys_first(renamed.drop("p_retailprice"), ["marca", "tipo"])


@query("filter_equality", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def filter_equality(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").filter(F.col("o_orderstatus") == "F").select("o_orderkey", "o_totalprice")


@query("filter_isin", "SELECT p_partkey, p_type FROM part WHERE p_type IN ('ECONOMY', 'PROMO', 'LARGE')")
def filter_isin(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").filter(F.col("p_type").isin("ECONOMY", "PROMO", "LARGE")).select("p_partkey", "p_type")


@query(
    "filter_not_null",
    """SELECT event_id, leitura FROM (SELECT event_id, CASE WHEN value >= 5 THEN value END AS leitura FROM events)
    WHERE leitura IS NOT NULL""",
)
def filter_not_null(spark: SparkSession, folder: str) -> DataFrame:
    readings = table(spark, folder, "events").select(
        "event_id", F.when(F.col("value") >= 5, F.col("value")).alias("leitura")
    )
    return readings.dropna(subset=["leitura"])


@query(
    "distinct_rows",
    "SELECT DISTINCT o_orderstatus, o_orderpriority, CAST(year(o_orderdate) AS INTEGER) AS ano FROM orders",
)
def distinct_rows(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select("o_orderstatus", "o_orderpriority", F.year("o_orderdate").alias("ano")).distinct()


@query(
    "semi_join_dim",
    """SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_custkey IN (
      SELECT c_custkey FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1))""",
)
def semi_join_dim(spark: SparkSession, folder: str) -> DataFrame:
    region = table(spark, folder, "nation").filter(F.col("n_regionkey") == 1).select(F.col("n_nationkey").alias("c_nationkey"))
    customers = keep_members(table(spark, folder, "customer"), region, "c_nationkey")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return keep_members_unsummed(orders, customers.select(F.col("c_custkey").alias("o_custkey")), "o_custkey").select(
        "o_orderkey", "o_custkey", "o_totalprice"
    )


@query(
    "filter_normalized_name",
    """SELECT n_nationkey, replace(replace(lower(n_name), 'a', 'ã'), 'o', 'ô') AS nome FROM nation
    WHERE upper(strip_accents(replace(replace(lower(n_name), 'a', 'ã'), 'o', 'ô')))
      IN ('NATION_1', 'NATION_7', 'NATION_12', 'NATION_24')""",
)
def filter_normalized_name(spark: SparkSession, folder: str) -> DataFrame:
    accented = F.translate(F.lower("n_name"), "ao", "ãô")
    names = table(spark, folder, "nation").select("n_nationkey", accented.alias("nome"))
    return names.filter(upper_ascii("nome").isin("NATION_1", "NATION_7", "NATION_12", "NATION_24"))


_DIRTY_SQL = """CASE WHEN value < 2 THEN 'na' WHEN value < 4 THEN '' WHEN value < 6 THEN 'x'
  ELSE CAST(value AS VARCHAR) END"""


@query(
    "reject_unparsable",
    f"""SELECT event_id, TRY_CAST(texto AS DOUBLE) AS valor, CAST(CAST(ano_texto AS DOUBLE) AS INTEGER) AS ano
    FROM (SELECT event_id, {_DIRTY_SQL} AS texto, CAST(year(ts) AS VARCHAR) || '.0' AS ano_texto FROM events)
    WHERE TRY_CAST(texto AS DOUBLE) IS NOT NULL""",
)
def reject_unparsable(spark: SparkSession, folder: str) -> DataFrame:
    value = F.col("value")
    dirty = F.when(value < 2, "na").when(value < 4, "").when(value < 6, "x").otherwise(value.cast("string"))
    texts = table(spark, folder, "events").select(
        "event_id", dirty.alias("texto"), F.concat(F.year("ts").cast("string"), F.lit(".0")).alias("ano_texto")
    )
    parsed = texts.select("event_id", to_number("texto").alias("valor"), to_whole("ano_texto").alias("ano"))
    return parsed.dropna(subset=["valor", "ano"])


@query(
    "prefix_flag",
    """SELECT o_orderkey, CASE WHEN o_orderpriority LIKE '1-%' OR o_orderpriority LIKE '2-%' THEN 1 ELSE 0 END
      AS flag_hidrica FROM orders""",
)
def prefix_flag(spark: SparkSession, folder: str) -> DataFrame:
    diagnosis = F.concat(F.lit(" "), F.lower("o_orderpriority"), F.lit(". "))
    flagged = starts_with_any(diagnosis_code(diagnosis), facts.URGENT)
    return table(spark, folder, "orders").select("o_orderkey", flagged.cast("int").alias("flag_hidrica"))


@query(
    "flag_share",
    """SELECT o_orderstatus, count(*) AS registros,
         count(*) FILTER (WHERE o_orderpriority LIKE '1-%' OR o_orderpriority LIKE '2-%') AS sinalizados,
         round(100.0 * count(*) FILTER (WHERE o_orderpriority LIKE '1-%' OR o_orderpriority LIKE '2-%') / count(*), 6)
           AS pct_sinalizados
    FROM orders GROUP BY 1""",
)
def flag_share(spark: SparkSession, folder: str) -> DataFrame:
    flagged = facts.urgent()
    return table(spark, folder, "orders").groupBy("o_orderstatus").agg(
        F.count("*").alias("registros"),
        F.count_if(flagged).alias("sinalizados"),
        F.round(100.0 * F.count_if(flagged) / F.count("*"), 6).alias("pct_sinalizados"),
    )
