"""Catalogue, entity graph and run history as DataFrame work."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LAYERS = ("raw", "clean", "mart")


def clean_entries(schemas: DataFrame, editorial: DataFrame) -> DataFrame:
    """(slug, title, description, columns, years): derived entries with editorial fields over them; editorial-only entries stay.

    ``schemas`` has (slug, year, columns); the newest year's columns stand for a dataset.
    """
    derived = schemas.groupBy("slug").agg(F.max_by("columns", "year").alias("columns"), F.array_sort(F.collect_set("year")).alias("years"))
    return derived.join(editorial, "slug", "full").select("slug", F.coalesce("title", F.initcap(F.translate("slug", "_-", "  "))).alias("title"), F.coalesce("description", F.lit("")).alias("description"), "columns", "years")


def mart_entries(datasets: DataFrame) -> DataFrame:
    """(slug, table, location) per mart table; flat if it spans years, else in its newest year."""
    each = datasets.select("slug", "years", "multi_year", F.explode("tables").alias("table"))
    place = F.when(F.col("multi_year"), F.concat(F.lit("data/mart/"), "slug", F.lit("/"), "table", F.lit(".parquet"))).otherwise(F.concat(F.lit("data/mart/"), "slug", F.lit("/"), F.array_max("years").cast("string"), F.lit("/"), "table", F.lit(".parquet")))
    return each.select("slug", "table", place.alias("location"))


def signals(runs: DataFrame) -> DataFrame:
    """(slug, status, action) of each dataset's newest run: error, warn or ok."""
    last = latest_runs(runs, ["slug"])
    status = F.when(F.col("status") != "SUCCESS", "error").when(F.col("warnings") > 0, "warn").otherwise("ok")
    return last.select("slug", status.alias("status"), F.when(status == "error", "rerun").when(status == "warn", "review").otherwise("none").alias("action"))


def backfill(current: DataFrame, previous: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """``current`` with null fields filled from the previous registry."""
    old = previous.select(key, *[F.col(f).alias(f"_{f}") for f in fields])
    joined = current.join(old, key, "left")
    return joined.select(*[F.coalesce(c, f"_{c}").alias(c) if c in fields else F.col(c) for c in current.columns])


def find(entries: DataFrame, text: str = "", metric_only: bool = False, limit: int = 15, files: DataFrame | None = None, layer: str | None = None, **equals) -> DataFrame:
    """(slug, matched_columns, meta_match, years, file_count, total_size_bytes, total_count, truncated) of entries whose slug, title or a column holds the text.

    ``entries`` has (slug, title, columns array<struct<name, role>>), ``files``
    (slug, layer, year, bytes).  ``limit`` 0 is all; ``total_count`` is how many
    there are without it.
    """
    low = text.lower()
    named = F.transform(F.filter("columns", lambda c: F.lower(c["name"]).contains(low) & ((c["role"] == "metric") if metric_only else F.lit(True))), lambda c: c["name"])
    meta = F.lower("slug").contains(low) | F.lower("title").contains(low)
    out = entries.withColumn("matched_columns", named).withColumn("meta_match", meta)
    for k, v in equals.items():
        out = out.filter(F.col(k) == v)
    hit = F.size("matched_columns") > 0
    if not metric_only:
        hit = hit | F.col("meta_match")
    found = out.filter(hit).select("slug", "matched_columns", "meta_match")
    if files is not None:
        some = files.filter(F.col("layer") == layer) if layer else files
        per = some.groupBy("slug").agg(F.array_sort(F.collect_set("year")).alias("years"), F.count("*").alias("file_count"), F.sum("bytes").alias("total_size_bytes"))
        found = found.join(per, "slug", "left")
    else:
        found = found.select("*", F.lit(None).cast("array<int>").alias("years"), F.lit(None).cast("long").alias("file_count"), F.lit(None).cast("long").alias("total_size_bytes"))
    none = F.lit(0).cast("long")
    plain = found.select("slug", "matched_columns", "meta_match", F.coalesce("years", F.array().cast("array<int>")).alias("years"), F.coalesce("file_count", none).alias("file_count"), F.coalesce("total_size_bytes", none).alias("total_size_bytes"))
    total = plain.agg(F.count("*").alias("total_count"))
    whole = (plain.orderBy("slug").limit(limit) if limit else plain).crossJoin(F.broadcast(total))  # total is one row
    return whole.withColumn("truncated", F.col("total_count") > limit if limit else F.lit(False)).orderBy("slug")


def resolve(files: DataFrame, slug: str, layer: str, year: int | None = None, table: str | None = None) -> DataFrame:
    """Files of a dataset's layer: local first, newest year first, then by path."""
    out = files.filter((F.col("slug") == slug) & (F.col("layer") == layer))
    out = out.filter(F.col("year") == year) if year is not None else out
    out = out.filter(F.col("table") == table) if table is not None else out
    return out.orderBy(F.desc("local"), F.desc("year"), "path")


def graph_nodes(columns: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(entity, datasets, types): datasets by (slug, column, semantic_type), and how often each type occurs.

    ``columns`` has (slug, column, semantic_type); ``vocabulary`` (semantic_type, entity).
    """
    edges = columns.join(vocabulary, "semantic_type")
    sets = edges.groupBy("entity").agg(F.array_sort(F.collect_set(F.struct("slug", "column", "semantic_type"))).alias("datasets"))
    counts = edges.groupBy("entity", "semantic_type").agg(F.count("*").alias("n")).groupBy("entity").agg(F.array_sort(F.collect_list(F.struct("semantic_type", "n"))).alias("types"))
    return sets.join(counts, "entity")


def graph_bridges(columns: DataFrame, vocabulary: DataFrame, bridges: DataFrame) -> DataFrame:
    """Distinct (from_entity, to_entity, bridge): datasets whose type a bridge table leads to another entity."""
    edges = columns.join(vocabulary, "semantic_type")
    return edges.join(bridges, "semantic_type").filter(F.col("entity") != F.col("to_entity")).select(F.col("entity").alias("from_entity"), "to_entity", "bridge").distinct()


def merge_graphs(nodes: DataFrame, bridges: DataFrame | None = None) -> DataFrame:
    """Graphs as one: (entity, datasets, types, bridges), datasets together, counts of types added, equal bridges once.

    ``nodes`` and ``bridges`` hold the rows of all graphs, as ``graph_nodes`` and
    ``graph_bridges`` give them.  An entity that only bridges name has no datasets.
    """
    sets = nodes.select("entity", F.explode("datasets").alias("d")).groupBy("entity").agg(F.array_sort(F.collect_set("d")).alias("datasets"))
    counts = nodes.select("entity", F.explode("types").alias("t")).groupBy("entity", "t.semantic_type").agg(F.sum("t.n").alias("n")).groupBy("entity").agg(F.array_sort(F.collect_list(F.struct("semantic_type", "n"))).alias("types"))
    whole = sets.join(counts, "entity")
    kind = "array<struct<to_entity: string, bridge: string>>"
    if bridges is None:
        return whole.withColumn("bridges", F.array().cast(kind))
    led = bridges.groupBy(F.col("from_entity").alias("entity")).agg(F.array_sort(F.collect_set(F.struct("to_entity", "bridge"))).alias("bridges"))
    named = bridges.select(F.col("to_entity").alias("entity")).distinct().join(led.select("entity"), "entity", "left_anti").withColumn("bridges", F.array().cast(kind))
    none = lambda c: F.coalesce(c, F.array().cast(whole.schema[c].dataType)).alias(c)
    return whole.join(led.unionByName(named), "entity", "full").select("entity", none("datasets"), none("types"), F.coalesce("bridges", F.array().cast(kind)).alias("bridges"))


#: Semantic types of each domain.
DOMAINS = {
    "appalti": ("cig_code", "ausa_code", "cpv_code"),
    "enti": ("fiscal_code", "ipa_code", "siope_code", "miur_code", "ssn_code", "sogei_code"),
    "territorio": ("municipality_code", "cadastral_code", "municipality_name", "province_code", "region_code", "nuts_code"),
    "giustizia": ("ricorso_number",),
    "scuola": ("school_code",),
    "progetti": ("cup_code",),
    "economia": ("ateco_code",),
}


def filter_graph(nodes: DataFrame, key: str | None = None, dataset: str | None = None, entity: str | None = None, domain: str | None = None) -> DataFrame:
    """Nodes with the datasets that pass all filters; nodes without one go."""
    keep = lambda d: F.lit(True)
    tests = []
    if key:
        tests.append(lambda d: d["semantic_type"] == key)
    if dataset:
        tests.append(lambda d: d["slug"] == dataset)
    if domain:
        tests.append(lambda d: d["semantic_type"].isin(*DOMAINS[domain]))

    def every(d):
        out = keep(d)
        for t in tests:
            out = out & t(d)
        return out

    out = nodes.filter(F.col("entity") == entity) if entity else nodes
    return out.withColumn("datasets", F.filter("datasets", every)).filter(F.size("datasets") > 0)


def runs(history: DataFrame, since=None, until=None, status: str | None = None, limit: int = 0) -> DataFrame:
    """Run records between two times and of one status, newest first; ``limit`` 0 is all."""
    out = history
    if since is not None:
        out = out.filter(F.col("started_at") >= F.lit(since).cast("timestamp_ntz"))
    if until is not None:
        out = out.filter(F.col("started_at") <= F.lit(until).cast("timestamp_ntz"))
    if status is not None:
        out = out.filter(F.col("status") == status)
    out = out.orderBy(F.desc("started_at"), "run_id")
    return out.limit(limit) if limit else out


def latest_runs(history: DataFrame, by: list[str]) -> DataFrame:
    """The newest run of each dataset (and year); ties go to the greater run_id."""
    rest = [c for c in history.columns if c not in by]
    return history.groupBy(*by).agg(F.max_by(F.struct(*rest), F.struct("started_at", "run_id")).alias("r")).select(*by, "r.*")


def seconds_between(start: Column, end: Column) -> Column:
    """Whole seconds; null while a layer runs, and for an end before its start."""
    s = F.timestamp_diff("SECOND", start, end)
    return F.when(s >= 0, s)


def resume_layer(layers: DataFrame, by: list[str]) -> DataFrame:
    """(by, layer): the first layer that failed or lacks its artefact; ``layers`` has (layer, status, has_artifact)."""
    order = F.array_position(F.array(*map(F.lit, LAYERS)), F.col("layer"))
    return layers.filter((F.col("status") != "SUCCESS") | ~F.col("has_artifact")).groupBy(*by).agg(F.min_by("layer", order).alias("layer"))


def to_ensure(expected: DataFrame, existing: DataFrame, on: list[str], refresh: bool = False) -> DataFrame:
    """What has to be produced: what does not exist, or everything on a refresh."""
    return expected if refresh else expected.join(existing, on, "left_anti")
