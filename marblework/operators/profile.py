"""Format inference and column profiles.

Files are (path, content) rows of a binaryFile read; lines are (path, n, line)
rows; cells are (column, n, value) rows.  Every inference is an aggregate per
file or column, so any number of files is profiled by one job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marblework.functions.text import snake_case, snake_name

#: Markers of a missing value, in the order in which they are listed.
NULL_TOKENS = ("", "-", "n.d.", "n.d", "ND", "NA", "N/A", "null", "NULL")
DELIMITERS = (";", ",", "\t", "|")
#: Parts of names whose texts are titles.
TITLE_PARTS = ("comune", "prov", "reg", "nome", "citt")


def binary_kind(content: Column) -> Column:
    """xls, xlsx or zip by the first bytes; null for anything else."""
    head = F.hex(F.substring(content, 1, 4))
    start = F.decode(F.substring(content, 1, 4096), "ISO-8859-1")
    return F.when(head == "D0CF11E0", "xls").when(head == "504B0304", F.when(start.contains("xl/") | start.contains("[Content_Types].xml"), "xlsx").otherwise("zip"))


def encoding(content: Column) -> Column:
    """utf-8-sig, utf-8 or windows-1252, the first that decodes."""
    return F.when(F.hex(F.substring(content, 1, 3)) == "EFBBBF", "utf-8-sig").when(F.is_valid_utf8(content), "utf-8").otherwise("windows-1252")


def numbered_lines(files: DataFrame, path: str = "path", text: str = "text") -> DataFrame:
    """(path, n, line), n from 1, without line ends."""
    return files.select(path, F.posexplode(F.split(F.regexp_replace(text, "\r\n?", "\n"), "\n")).alias("n", "line")).select(path, (F.col("n") + 1).alias("n"), "line")


def delimiter(lines: DataFrame, path: str = "path", first: int = 25) -> DataFrame:
    """(path, delimiter): the one in most of the first non-blank lines, then the steadiest, then the most frequent."""
    head = lines.filter(F.trim("line") != "").withColumn("_r", F.row_number().over(Window.partitionBy(path).orderBy("n"))).filter(F.col("_r") <= first)
    each = F.explode(F.array(*[F.struct(F.lit(-i).alias("place"), F.lit(d).alias("d")) for i, d in enumerate(DELIMITERS)]))
    counted = head.select(path, "line", each.alias("x")).select(path, "x.*", (F.length("line") - F.length(F.replace("line", F.col("x.d"), F.lit("")))).alias("c"))
    per = counted.groupBy(path, "d", "place").agg(F.count_if(F.col("c") > 0).alias("with"), F.coalesce(F.max(F.when(F.col("c") > 0, F.col("c"))) - F.min(F.when(F.col("c") > 0, F.col("c"))), F.lit(0)).alias("spread"), F.sum("c").alias("total"))
    best = F.max(F.struct("with", -F.col("spread"), "total", "place", "d"))
    return per.groupBy(path).agg(best.alias("b")).select(path, F.when(F.col("b.with") > 0, F.col("b.d")).otherwise(";").alias("delimiter"))


#: Fields that vote for a comma or a point, and the pair of neighbours that a comma as delimiter makes of 1.234,56.
COMMA_FIELD, POINT_FIELD = r"^\d+,\d{1,2}$|^\d+\.\d{3},\d{1,2}$", r"^\d+\.\d{1,3}$"
SPLIT_PAIR = (r"^\d+\.\d{3}$", r"^\d{1,2}$")


def decimal_mark(lines: DataFrame, path: str = "path", delimiter_column: str = "delimiter") -> DataFrame:
    """(path, decimal): comma or point by votes of the fields and of neighbouring fields of all lines.

    A tie is a comma; null where nothing votes.
    """
    fields = F.transform(F.split("line", F.concat(F.lit("\\Q"), F.col(delimiter_column), F.lit("\\E"))), lambda x: F.regexp_replace(F.trim(x), r'^"+|"+$', ""))
    votes = lambda pattern: F.size(F.filter("_fields", lambda x: x.rlike(pattern)))
    pairs = F.size(F.filter(F.arrays_zip(F.col("_fields").alias("a"), F.slice("_fields", F.lit(2), F.greatest(F.size("_fields") - 1, F.lit(0))).alias("b")), lambda p: p["a"].rlike(SPLIT_PAIR[0]) & F.coalesce(p["b"], F.lit("")).rlike(SPLIT_PAIR[1])))
    one = lines.select(path, fields.alias("_fields")).groupBy(path).agg(F.sum(votes(COMMA_FIELD) + pairs).alias("comma"), F.sum(votes(POINT_FIELD)).alias("point"))
    return one.select(path, F.when(F.col("comma") + F.col("point") > 0, F.when(F.col("comma") >= F.col("point"), ",").otherwise(".")).alias("decimal"))


def skip_lines(lines: DataFrame, path: str = "path", delimiter_column: str = "delimiter") -> DataFrame:
    """(path, skip): 1 if the first line holds no delimiter and the second one does."""
    c = F.length("line") - F.length(F.replace("line", F.col(delimiter_column), F.lit("")))
    one = lines.filter("n <= 2").groupBy(path).agg(F.max(F.when(F.col("n") == 1, c)).alias("a"), F.max(F.when(F.col("n") == 2, c)).alias("b"))
    return one.select(path, F.when((F.col("a") == 0) & (F.coalesce("b", F.lit(0)) > 0), 1).otherwise(0).alias("skip"))


def header_mismatch(lines: DataFrame, path: str = "path", delimiter_column: str = "delimiter") -> DataFrame:
    """(path, robust): whether some row has more fields than the header."""
    c = F.size(F.split("line", F.concat(F.lit("\\Q"), F.col(delimiter_column), F.lit("\\E"))))
    one = lines.filter(F.trim("line") != "").groupBy(path).agg(F.max(F.when(F.col("n") == 1, c)).alias("head"), F.max(F.when(F.col("n") > 1, c)).alias("most"))
    return one.select(path, (F.coalesce("most", F.lit(0)) > F.col("head")).alias("robust"))


def column_kinds(cells: DataFrame, sample: int = 30) -> DataFrame:
    """(column, kind, type, null_tokens, normalize) from each column's first ``sample`` non-blank values.

    The sample is the feature: a profile says what a file looks like.  It is
    taken per column with a limit that tasks apply before they shuffle.
    """
    filled = cells.select("column", "n", F.trim("value").alias("v")).filter("v <> ''")
    some = filled.withColumn("_r", F.row_number().over(Window.partitionBy("column").orderBy("n"))).filter(F.col("_r") <= sample)
    v = F.replace("v", F.lit(" "), F.lit(""))
    share = lambda x: F.greatest(F.lit(2), F.floor(F.col("values") * x))
    one = some.groupBy("column").agg(
        F.count("*").alias("values"),
        F.count_if(F.col("v").contains("%")).alias("pct"),
        F.count_if(v.rlike(r"\d{1,3}(\.\d{3})+,\d+|\d+,\d{1,3}\b")).alias("it"),
        F.count_if(v.rlike(r"^-?\d+$")).alias("ints"),
        F.count_if(v.rlike(r"^-?\d+[.,]\d+$")).alias("floats"),
        F.collect_set(F.when(F.col("v").isin(*NULL_TOKENS), F.col("v"))).alias("marks"),
    )
    kind = F.when(F.col("pct") >= share(0.3), "percent_it").when(F.col("it") >= share(0.3), "number_it")
    typed = F.when(F.col("kind").isNotNull(), "float").when(F.col("ints") >= share(0.6), "int").when(F.col("ints") + F.col("floats") >= share(0.6), "float").otherwise("str")
    title = F.lower("column").rlike("|".join(TITLE_PARTS))
    return one.withColumn("kind", kind).withColumn("type", typed).select(
        "column",
        "kind",
        "type",
        F.filter(F.array(*map(F.lit, NULL_TOKENS)), lambda t: F.array_contains("marks", t)).alias("null_tokens"),
        F.when(F.col("type") == "str", F.when(title, F.array(*map(F.lit, ("trim", "title", "collapse_spaces")))).otherwise(F.array(F.lit("trim"), F.lit("collapse_spaces")))).alias("normalize"),
    )


_DAY = r"^\d{1,2}[/.-]\d{1,2}[/.-]\d{4}$|^\d{4}[/.-]\d{1,2}[/.-]\d{1,2}$"
#: Date formats in the order in which ties prefer them.
DATE_FORMATS = ("dd/MM/yyyy", "MM/dd/yyyy", "yyyy/MM/dd", "yyyy-MM-dd")


def date_columns(cells: DataFrame, sample: int = 30, least: float = 0.6) -> DataFrame:
    """(column): at least ``least`` of the first values look like dates."""
    some = cells.filter(F.trim("value") != "").withColumn("_r", F.row_number().over(Window.partitionBy("column").orderBy("n"))).filter(F.col("_r") <= sample)
    return some.groupBy("column").agg(F.avg(F.trim("value").rlike(_DAY).cast("int")).alias("share")).filter(F.col("share") >= least).select("column")


def date_formats(cells: DataFrame, least: float = 0.6) -> DataFrame:
    """(column, format): the format that reads most values, if it reads enough of them."""
    good = lambda f: F.count_if(F.try_to_timestamp("value", F.lit(f)).isNotNull())
    per = cells.filter(F.trim("value") != "").groupBy("column").agg(F.count("*").alias("all"), *[good(f).alias(f"_{i}") for i, f in enumerate(DATE_FORMATS)])
    best = F.array_max(F.array(*[F.struct(F.col(f"_{i}").alias("c"), F.lit(-i).alias("place"), F.lit(f).alias("f")) for i, f in enumerate(DATE_FORMATS)]))
    return per.select("column", "all", best.alias("b")).filter(F.col("b.c") >= least * F.col("all")).select("column", F.col("b.f").alias("format"))


def common_date_format(formats: DataFrame) -> DataFrame:
    """One row (format): the format of all columns, null if they differ."""
    return formats.agg(F.when(F.count_distinct("format") == 1, F.first("format")).alias("format"))


#: Names of a year column.
YEAR_NAMES = ("anno", "year", "anno_riferimento", "anno_di_riferimento", "annualita")


def is_year_name(name: str) -> bool:
    """Whether a name marks a year column."""
    return snake_name(name) in YEAR_NAMES


def year_columns(columns: DataFrame, name: str = "name") -> DataFrame:
    """Columns that a name marks as the year."""
    return columns.filter(snake_case(F.col(name)).isin(*YEAR_NAMES))


def year_values(cells: DataFrame) -> DataFrame:
    """(column, low, high) of columns with two values or more between 1900 and 2100."""
    y = F.col("value").try_cast("int")
    ok = y.between(1900, 2100)
    return cells.groupBy("column").agg(F.count_if(ok).alias("n"), F.min(F.when(ok, y)).alias("low"), F.max(F.when(ok, y)).alias("high")).filter("n >= 2").select("column", "low", "high")


def read_hints(encodings: DataFrame, delimiters: DataFrame, decimals: DataFrame, skips: DataFrame, robust: DataFrame, path: str = "path") -> DataFrame:
    """(path, hints): reader options of each file."""
    joined = encodings.join(delimiters, path).join(decimals, path).join(skips, path).join(robust, path)
    return joined.select(path, F.struct("encoding", "delimiter", "decimal", "skip", "robust").alias("hints"))


def header_real(first: Column, columns: Column) -> Column:
    """Whether a file's first row is its header: no cell of it is a number and most name a known column."""
    plain = F.transform(first, lambda x: F.lower(F.trim(x)))
    numbers = F.exists(plain, lambda x: x.rlike(r"^-?[\d.,]+$"))
    return ~numbers & (F.size(F.array_intersect(plain, F.transform(columns, F.lower))) * 2 >= F.size(first))


#: The column names of each semantic type; a name that stands in two types belongs to the first.
ALIASES = {
    "municipality_code": ["codice_istat", "codice_istat_comune", "codice_istat_luogo", "codice_comune", "cod_comune", "pro_com", "codice_comune_istat", "localizzazione_codice_istat", "comune_istat", "cod_istat_comune", "comune_codice", "cod_comune_istat", "ente_codice_comune_istat", "codice_comune_comune"],
    "cadastral_code": ["codice_catastale", "cod_catastale", "catastale", "codice_belfiore", "codice_comune_scuola"],
    "municipality_name": ["comune", "denominazione_comune", "comune_denominazione", "comune_descrizione"],
    "province_code": ["provincia", "sigla_provincia", "sigla_provincia_pa", "sigla_provincia_asl", "sigla_provincia_struttura", "codice_provincia", "sigla_prov", "cod_prov"],
    "region_code": ["regione", "codice_regione", "cod_regione", "cod_reg", "regione_codice", "istat_regione", "regione_istat_cod", "regione_beneficiario", "amministrazione_regione_sede"],
    "nuts_code": ["geo", "nuts", "nuts2", "nuts3", "nuts_code", "codice_nuts"],
    "fiscal_code": ["codice_fiscale", "codice_fiscale_ente", "cf", "cf_amministrazione_appaltante", "cf_soggetto_attuatore", "cf_subappaltante", "amministrazione_codice_fiscale", "partita_iva", "p_iva", "piva", "codi_fiscale", "codice_fiscale_beneficiario"],
    "ipa_code": ["codice_ipa", "ipa", "cod_ipa"],
    "cig_code": ["cig", "codice_cig", "cig_accordo_quadro", "cig_prog_esterna", "cig_collegamento"],
    "cup_code": ["cup", "codice_cup"],
    "ausa_code": ["codice_ausa", "ausa"],
    "cpv_code": ["cod_cpv", "codice_cpv", "cpv", "cod_cpv_principale"],
    "school_code": ["codice_scuola", "codicescuola", "codice_meccanografico", "cod_scuola"],
    "siope_code": ["codice_ente"],
    "miur_code": ["codice_ente_miur"],
    "ssn_code": ["codice_ente_ssn"],
    "sogei_code": ["username"],
    "ateco_code": ["ateco", "codice_ateco", "sezione_ateco", "ateco_code"],
    "country_code": ["nazione", "stato", "paese", "country", "codice_nazione"],
    "year": ["anno", "year", "anno_di_imposta", "anno_riferimento", "esercizio_finanziario"],
    "month": ["mese", "month", "periodo"],
    "person_id": ["persona_id", "person_id", "id_persona", "codice_persona"],
    "senator_id": ["senatore_id"],
    "ddl_id": ["ddl_id", "id_ddl"],
    "gruppo_parlamentare": ["gruppo", "gruppo_parlamentare"],
    "ricorso_number": ["numero_ricorso", "numero_provvedimento", "n_ricorso"],
}
DIMENSION_TYPES = ("string", "date", "boolean", "timestamp", "timestamp_ntz")


def roles(columns: DataFrame, aliases: dict[str, list[str]] | None = None) -> DataFrame:
    """All of ``columns`` (name, type) with role and semantic_type: a known name or a text, date or flag is a dimension."""
    first: dict[str, str] = {}
    for kind, names in (aliases or ALIASES).items():
        for name in names:
            first.setdefault(name, kind)
    known = F.try_element_at(F.create_map(*[F.lit(x) for p in first.items() for x in p]), F.lower("name"))
    return columns.withColumn("semantic_type", known).withColumn("role", F.when(F.col("semantic_type").isNotNull() | F.col("type").isin(*DIMENSION_TYPES), "dimension").otherwise("metric"))


def batch_profiles(values: DataFrame, top_n: int = 20) -> DataFrame:
    """(slug, repo, year, column, value, n, rank): the most frequent values of each column of many datasets.

    ``values`` has (repo, slug, year, column, value).  A slug that stands in
    several repositories is taken from the first by name, in its newest year.
    Only counted values reach the ranking, which tasks limit before they shuffle.
    """
    newest = values.groupBy("slug").agg(F.min(F.struct("repo", (-F.col("year")).alias("_age"))).alias("k")).select("slug", F.col("k.repo").alias("repo"), (-F.col("k._age")).alias("year"))
    counts = values.join(newest, ["slug", "repo", "year"], "left_semi").groupBy("slug", "repo", "year", "column", "value").agg(F.count("*").alias("n"))
    rank = F.row_number().over(Window.partitionBy("slug", "column").orderBy(F.desc("n"), "value"))
    return counts.filter("value IS NOT NULL").withColumn("rank", rank).filter(F.col("rank") <= top_n)
