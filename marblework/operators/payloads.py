"""Semi-structured payloads, landed as text, to rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marblework.operators.numbering import with_start

_DIM = "array<struct<id:string,values:array<struct<id:string,name:string>>>>"
SDMX = f"struct<dataSets:array<struct<series:map<string,struct<observations:map<string,array<double>>>>>>,structure:struct<dimensions:struct<series:{_DIM},observation:{_DIM}>>>"


def sdmx_rows(df: DataFrame, payload: str = "payload") -> DataFrame:
    """The other columns, dims (map of dimension to code), labels (map to name) and value of each observation.

    An index outside its dimension's list is an error.
    """
    doc = df.withColumn("_d", F.from_json(payload, SDMX)).drop(payload)
    dims = doc.withColumn("_series", F.col("_d.structure.dimensions.series")).withColumn("_obs", F.col("_d.structure.dimensions.observation"))
    keep = [c for c in dims.columns if c != "_d"]
    series = dims.select(*keep, F.explode("_d.dataSets").alias("_s")).select(*keep, F.explode("_s.series").alias("_sk", "_sv"))
    seen = series.select(*keep, "_sk", F.explode("_sv.observations").alias("_ok", "_ov"))

    def decoded(key: str, of: str) -> Column:
        at = lambda v, i: F.coalesce(F.get(v["values"], i.cast("int")), F.raise_error(F.concat(F.lit("index out of range in "), v["id"])).cast("struct<id:string,name:string>"))
        return F.zip_with(F.col(of), F.split(F.col(key), ":"), lambda v, i: F.struct(v["id"].alias("dim"), at(v, i).alias("x")))

    every = F.concat(decoded("_sk", "_series"), decoded("_ok", "_obs"))
    plain = [c for c in keep if c not in ("_series", "_obs")]
    pick = lambda f: F.map_from_entries(F.transform("_e", lambda e: F.struct(e["dim"], e["x"][f])))
    return seen.select(*plain, every.alias("_e"), F.get("_ov", F.lit(0)).alias("value")).select(*plain, pick("id").alias("dims"), pick("name").alias("labels"), "value")


def tsv_cell(c: Column) -> Column:
    """struct<value, flag> of a cell such as ``37300 d``; a colon or nothing is empty; a bad number keeps its flag."""
    t = F.trim(F.coalesce(c, F.lit("")))
    flag = F.nullif(F.regexp_extract(t, r"\s+([a-z]+)$", 1), F.lit(""))
    number = F.trim(F.regexp_replace(t, r"\s+[a-z]+$", ""))
    return F.struct(F.when(number != ":", number.try_cast("double")).alias("value"), flag.alias("flag"))


def tsv_rows(lines: DataFrame, header: str, line: str = "line") -> DataFrame:
    """Wide rows to (dims map, year, month, value, flag); ``header`` is ``dim1,..,dimN\\TIME`` and the periods, by tabs."""
    first, *periods = header.split("\t")
    names = first.split("\\")[0].split(",")
    cells = F.split(line, "\t")
    dims = F.map_from_arrays(F.array(*map(F.lit, names)), F.transform(F.split(cells[0], ","), lambda x: F.trim(x)))
    pairs = F.arrays_zip(F.array(*[F.lit(p.strip()) for p in periods]).alias("period"), F.slice(cells, 2, len(periods)).alias("cell"))
    long = lines.select(dims.alias("dims"), F.explode(pairs).alias("p"))
    year, month = F.split_part("p.period", F.lit("-"), F.lit(1)), F.split_part("p.period", F.lit("-"), F.lit(2))
    return long.select("dims", year.cast("int").alias("year"), month.try_cast("int").alias("month"), tsv_cell(F.col("p.cell")).alias("c")).select("dims", "year", "month", "c.value", "c.flag")


def sparql_rows(df: DataFrame, names: list[str], payload: str = "payload") -> DataFrame:
    """The other columns and one column per variable; a missing binding is empty.  An empty result is an error."""
    kind = "struct<head:struct<vars:array<string>>,results:struct<bindings:array<map<string,struct<value:string>>>>>"
    doc = df.withColumn("_d", F.from_json(payload, kind)).drop(payload)
    bound = F.col("_d.results.bindings")
    doc = doc.withColumn("_b", F.when(F.size(bound) > 0, bound).otherwise(F.raise_error(F.lit("empty result")).cast("array<map<string,struct<value:string>>>")))
    rest = [c for c in doc.columns if c not in ("_d", "_b")]
    return doc.select(*rest, F.explode("_b").alias("_x")).select(*rest, *[F.coalesce(F.try_element_at("_x", F.lit(v))["value"], F.lit("")).alias(v) for v in names])


def ckan_records(pages: DataFrame, fields: list[str], page: str = "page", payload: str = "payload") -> DataFrame:
    """Records of landed DataStore pages as text columns, null where absent; records past the stated total drop."""
    doc = pages.select(page, F.from_json(payload, "struct<result:struct<total:long,records:array<map<string,string>>>>").alias("d"))
    rows = with_start(doc, [page], F.greatest(F.size("d.result.records"), F.lit(0)), "before").select(page, "before", "d.result.total", F.posexplode("d.result.records").alias("i", "r"))
    kept = rows.filter(F.col("total").isNull() | (F.col("before") + F.col("i") < F.col("total")))
    return kept.select(page, "i", *[F.try_element_at("r", F.lit(f)).alias(f) for f in fields])


def page_end(pages: DataFrame, step: int, page: str = "page", rows: str = "rows") -> DataFrame:
    """Pages up to the first one with fewer than ``step`` rows, itself included unless it is empty."""
    last = pages.filter(F.col(rows) < step).agg(F.min(page).alias("_last"))
    return pages.crossJoin(F.broadcast(last)).filter(F.col("_last").isNull() | (F.col(page) < F.col("_last")) | (F.col(page) == F.col("_last")) & (F.col(rows) > 0)).drop("_last")


def keyset_last(rows: DataFrame, key: str, position: str, by: list[str]) -> DataFrame:
    """(by, last, literal): the last non-empty key of each page and how a query writes it."""
    full = rows.filter((F.col(key).isNotNull()) & (F.col(key) != ""))
    last = full.groupBy(*by).agg(F.max_by(key, position).alias("last"))
    k = F.col("last")
    return last.withColumn("literal", F.when(k.rlike(r"^https?://"), F.concat(F.lit("<"), k, F.lit(">"))).when(k.rlike(r"^-?\d+(\.\d+)?$"), k).otherwise(F.concat(F.lit('"'), F.replace(F.replace(k, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"'))))


def csv_data_rows(text: Column) -> Column:
    """Rows of a page of CSV without its header; line ends inside quotes do not count."""
    plain = F.regexp_replace(text, r'"[^"]*"', "q")
    return F.greatest(F.lit(0), F.size(F.filter(F.split(plain, "\r?\n"), lambda x: x != "")) - 1)


def constraint_check(filters: DataFrame, allowed: DataFrame) -> DataFrame:
    """(dim, code, problem): filters on unknown dimensions or with codes that are not allowed."""
    dims = allowed.select("dim").distinct()
    unknown = filters.join(dims, "dim", "left_anti").withColumn("problem", F.lit("unknown dimension"))
    bad = filters.join(dims, "dim", "left_semi").join(allowed, ["dim", "code"], "left_anti").withColumn("problem", F.lit("code not allowed"))
    return unknown.unionByName(bad)


#: The order in which resource formats are preferred.
FORMAT_RANK = {"csv": 0, "zip": 1, "xlsx": 2, "xls": 2, "json": 3, "xml": 4}


def ckan_resources(packages: DataFrame, payload: str = "payload") -> DataFrame:
    """Downloadable resources of landed packages: the other columns, id, name, format, url."""
    kind = "struct<resources:array<struct<id:string,name:string,description:string,format:string,url:string>>>"
    doc = packages.withColumn("_d", F.from_json(payload, kind)).drop(payload)
    rest = [c for c in doc.columns if c != "_d"]
    each = doc.select(*rest, F.explode("_d.resources").alias("r")).filter(F.col("r.url").rlike("^https?://"))
    return each.select(*rest, "r.id", F.coalesce(F.nullif("r.name", F.lit("")), "r.description", "r.id").alias("name"), F.lower("r.format").alias("format"), "r.url")


def ckan_rank(resources: DataFrame, by: list[str]) -> DataFrame:
    """The best resource of each package: by format, then by name."""
    rank = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in FORMAT_RANK.items() for x in kv]), F.col("format")), F.lit(9))
    cells = F.struct(rank.alias("rank"), "name", "id", "url", "format")
    return resources.groupBy(*by).agg(F.min(cells).alias("b")).select(*by, "b.id", "b.name", "b.format", "b.url")


def is_csv_resource(name: Column, format_: Column) -> Column:
    """CSV or zip, and no log."""
    return F.lower(format_).isin("csv", "zip", "text/csv") & ~F.lower(name).contains("logcsv")


def codelist(df: DataFrame, payload: str = "payload") -> DataFrame:
    """(code, label_en, one column per annotation type) of a landed code list; absent annotations are empty."""
    kind = "struct<category:struct<label:map<string,string>>,extension:struct<`code-annotation`:map<string,array<struct<type:string,title:string>>>>>"
    doc = df.select(F.from_json(payload, kind).alias("d"))
    labels = doc.select(F.explode("d.category.label").alias("code", "label_en"))
    notes = doc.select(F.explode("d.extension.`code-annotation`").alias("code", "xs")).select("code", F.explode("xs").alias("x")).groupBy("code").pivot("x.type").agg(F.first("x.title"))
    joined = labels.join(notes, "code", "left")
    return joined.select("code", *[F.coalesce(c, F.lit("")).alias(c) for c in joined.columns if c != "code"])
