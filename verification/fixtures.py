"""Occurrence inputs as views over the test tables.

The column expressions are SQL that Spark and DuckDB read alike. Only these input
views are shared; what is computed from them is written twice, independently.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

PREFIXES = {
    "l": "lineitem",
    "o": "orders",
    "p": "part",
    "s": "supplier",
    "n": "nation",
    "r": "region",
}

BINOMIAL = "concat(p_name, ' ', cast(p_partkey as varchar(12)))"

# Columns added to a table before the views read it.
HELPERS = {
    "part": {
        "p_status_rule": """case when p_partkey % 7 = 3 then 7 when p_partkey % 11 = 2 then 11
            when p_partkey % 13 = 5 then 13 when p_partkey % 29 = 6 then 29 else 0 end""",
        "p_group": """case
            when p_type like 'ECONOMY%' then 'bryophytes'
            when p_type like 'SMALL%' then 'ferns and allies'
            when p_type like 'MEDIUM%' then 'flowering plants'
            when p_type like 'PROMO%' then 'gymnosperms (conifers)'
            when p_type like 'STANDARD%' then 'gymnosperms (non-conifer)'
            else 'algae' end""",
        "p_native_rule": "case p_partkey % 5 when 0 then 0 when 1 then 1 else 2 end",
    },
    "supplier": {
        "s_status_3": "case s_suppkey % 3 when 0 then 'A' when 1 then 'UNK' end",
        "s_status_7": """case s_suppkey % 7 when 0 then 'A' when 1 then 'UNK' when 2 then 'I'
            when 3 then 'N' when 4 then 'Ne' end""",
        "s_introduced_7": "case when s_suppkey % 7 in (0, 3, 4) then 0 when s_suppkey % 7 = 2 then 1 end",
    },
}

OCC = {
    "taxonobservation_id": "cast(l_orderkey * 10000000000 + l_partkey * 100000 + l_suppkey * 10 + l_linenumber as bigint)",
    "scrubbed_species_binomial": f"case when p_partkey % 97 = 0 then null else {BINOMIAL} end",
    "latitude": "l_quantity",
    "longitude": "l_extendedprice / cast(1000 as double)",
    "scrubbed_taxonomic_status": """case p_status_rule
        when 7 then case when o_orderpriority = '1-URGENT' then 'No opinion' else 'Unresolved' end
        when 11 then case l_returnflag when 'R' then 'Unresolved' when 'N' then 'No opinion' else 'Accepted' end
        when 13 then case when l_returnflag = 'R' then null else 'Accepted' end
        when 29 then case when l_returnflag = 'R' then 'Synonym' else 'Unresolved' end
        else 'Accepted' end""",
    "higher_plant_group": "case when p_partkey % 17 = 4 and l_linestatus = 'F' then 'bryophytes' else p_group end",
    "country": "n_name",
    "continent": "r_name",
    "native_status": """case p_native_rule when 0 then s_status_3 when 1 then null else s_status_7 end""",
    "is_introduced": """case p_native_rule
        when 0 then case when p_partkey % 2 = 0 and s_suppkey % 3 = 0 then 0 end
        when 1 then null else s_introduced_7 end""",
    "observation_type": """case substring(o_orderpriority, 1, 1)
        when '1' then 'plot' when '2' then 'specimen' when '3' then 'literature'
        when '4' then 'checklist' else 'human observation' end""",
    "event_date": """case
        when l_linestatus = 'F' and l_linenumber = 1 then null
        when l_linenumber = 2 then cast('1949-12-31' as date)
        else cast(l_shipdate as date) end""",
    "is_invalid_latlong": "cast(case when l_discount > 0.095 then 1 else 0 end as int)",
    "is_geovalid": "cast(case when l_tax > 0.075 then 0 else 1 end as int)",
    "georef_protocol": "case o_orderstatus when 'P' then 'county_centroid' when 'F' then null else 'gps' end",
    "is_centroid": "cast(case l_linenumber when 3 then 1 when 4 then null else 0 end as int)",
    "is_location_cultivated": "cast(case when l_discount < 0.005 then 1 end as int)",
    "is_cultivated_observation": "cast(case when l_tax < 0.005 then 1 when l_tax < 0.015 then null else 0 end as int)",
    "scrubbed_family": "p_brand",
    "scrubbed_taxon_name_no_author": f"""case when l_returnflag = 'A' and p_partkey % 11 = 2
        then concat({BINOMIAL}, ' var. x') else {BINOMIAL} end""",
    "scrubbed_author": "concat('Auth', cast(s_suppkey % 3 as varchar(12)))",
    "datasource": "s_name",
    "dataset": "concat('DS', cast(s_suppkey % 9 as varchar(12)))",
    "locality": "concat('near ', s_name, ' by ', o_orderpriority, ' plot marker and stream bed')",
    "scrubbed_genus": "split_part(p_name, ' ', 1)",
    "datasetkey": "concat('key', cast(s_suppkey % 9 as varchar(12)))",
    "fk_tnrs_id": "cast(p_partkey as bigint)",
    "verbatim_scientific_name": BINOMIAL,
    "name_matched": BINOMIAL,
    "name_matched_author": "cast(null as varchar(12))",
    "matched_taxonomic_status": "cast('Accepted' as varchar(12))",
    "invalid_latlong_reason": "cast(null as varchar(12))",
    "fk_gnrs_id": "cast(n_nationkey as bigint)",
    "fk_cds_id": "cast(null as bigint)",
    "nsr_id": "cast(s_suppkey as bigint)",
    "event_date_verbatim": "cast(null as varchar(12))",
    "date_collected_verbatim": "cast(cast(l_shipdate as date) as varchar(12))",
}

# Made of keys that move to the joins anyway: put together after them, it does not move besides.
AFTER_JOINS = {"taxonobservation_id"}

GF = "case p_partkey % 4 when 1 then 'tree' when 2 then 'shrub' else 'herb' end"
META_STATUS = "case when p_partkey % 7 = 3 then 'Unresolved' else 'Accepted' end"

# name -> (table, columns, predicate)
LOOKUPS = {
    "species_growth_forms": (
        "part",
        {
            "species": BINOMIAL,
            "family": "p_brand",
            "gf": GF,
            "gf_conf_flag": "case when p_partkey % 3 = 0 then 'low' else 'high' end",
        },
        "p_partkey % 4 <> 0",
    ),
    "country": (
        "nation",
        {
            "country": "n_name",
            "iso_alpha3": """case n_nationkey when 0 then 'GLP' when 1 then 'MTQ' when 2 then 'BLM'
                when 3 then 'MAF' when 4 then 'GUF' when 5 then 'PYF' when 6 then 'ATF' when 7 then 'CUB'
                when 8 then 'GRD' when 9 then 'JAM' else concat('X', cast(n_nationkey as varchar(12))) end""",
        },
        "1 = 1",
    ),
    "range_model_data_metadata": (
        "part",
        {
            "scrubbed_species_binomial": BINOMIAL,
            "family": "p_brand",
            "taxonomic_status": META_STATUS,
            "higher_plant_group": "p_type",
            "filter_group": """case when p_partkey % 6 = 0 then null
                when p_partkey % 2 = 0 then 'common' else 'rare' end""",
            "gf": GF,
        },
        "p_partkey % 8 <> 0",
    ),
    "species_observation_counts_crosstab": (
        "part",
        {
            "species": BINOMIAL,
            "6. year>=1970": "cast(p_size * 3 as int)",
            "7. is_introduced": "cast(p_size * 2 as int)",
            "8. observation_type": "cast(p_size as int)",
        },
        "p_partkey % 9 <> 0",
    ),
    "all_species": (
        "part",
        {
            "species": BINOMIAL,
            "genus": "split_part(p_name, ' ', 1)",
            "family": "p_brand",
            "taxonomic_status": META_STATUS,
            "higher_plant_group": "p_type",
            "is_vascular": "cast(case when p_type like 'LARGE%' then 0 else 1 end as int)",
        },
        "1 = 1",
    ),
    "checklist_species": ("part", {"species": BINOMIAL}, "p_partkey % 5 >= 2"),
    # Names below species rank, and several rows for a name, as in a place-by-place table.
    "distribution": (
        "part",
        {
            "taxon": BINOMIAL,
            "taxon_rank": "case p_partkey % 3 when 0 then 'variety' else 'species' end",
        },
        "1 = 1",
    ),
}


_schemas: dict[str, StructType] = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table. Its schema is read from the file once, as a catalog would keep it."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def _split(columns: dict[str, str]) -> tuple[dict[str, dict[str, str]], dict[str, str]]:
    """Columns that one table alone defines, by table, and the others with those of ``AFTER_JOINS``."""
    own: dict[str, dict[str, str]] = {table: {} for table in PREFIXES.values()}
    mixed = {}
    for name, sql in columns.items():
        tables = {PREFIXES[p] for p in re.findall(r"\b([lopsnr])_\w+", sql)}
        (own[tables.pop()] if len(tables) == 1 and name not in AFTER_JOINS else mixed)[name] = sql
    return own, mixed


def occurrences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The occurrence view.

    What one table alone defines is computed before it is joined: once per part or
    supplier instead of once per observation, and in generated methods small
    enough for the JVM to compile. Every lookup is joined straight from its file,
    whose size Spark knows, so that the small ones are broadcast.
    """
    own, mixed = _split(OCC)

    def table(name: str) -> DataFrame:
        computed = {**HELPERS.get(name, {}), **own[name]}
        return _table(spark, sf_dir, name).selectExpr(
            "*", *[f"{sql} AS `{column}`" for column, sql in computed.items()]
        )

    joined = (
        table("lineitem")
        .join(table("orders"), F.expr("l_orderkey = o_orderkey"))
        .join(table("part"), F.expr("l_partkey = p_partkey"))
        .join(table("supplier"), F.expr("l_suppkey = s_suppkey"))
        .join(table("nation"), F.expr("s_nationkey = n_nationkey"))
        .join(table("region"), F.expr("n_regionkey = r_regionkey"))
    )
    return joined.selectExpr(
        *[f"{mixed[c]} AS `{c}`" if c in mixed else f"`{c}`" for c in OCC]
    )


def lookup(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    table, columns, where = LOOKUPS[name]
    df = _table(spark, sf_dir, table).filter(where)
    if name == "distribution":
        sales = _table(spark, sf_dir, "lineitem").select("l_partkey")
        df = sales.join(df, F.col("l_partkey") == F.col("p_partkey"))
    return df.select(*[F.expr(sql).alias(column) for column, sql in columns.items()])


def country_species(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Species observed per country, with attributes."""
    occ = occurrences(spark, sf_dir)
    pairs = occ.filter("scrubbed_species_binomial is not null").groupBy(
        "country", F.col("scrubbed_species_binomial").alias("species")
    ).agg(F.max(F.when(F.col("is_introduced") == 0, 1).otherwise(0)).alias("is_native"))
    species = lookup(spark, sf_dir, "all_species").select(
        "species",
        F.when(F.col("taxonomic_status") == "Accepted", 1).otherwise(0).alias("is_accepted"),
        "is_vascular",
    )
    return pairs.join(species, "species").select(
        "country", "species", "is_accepted", "is_vascular", "is_native"
    )


def country_species_sdm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Modelled species per country, with filter group and status there."""
    occ = occurrences(spark, sf_dir)
    pairs = occ.filter("scrubbed_species_binomial is not null").groupBy(
        "country", F.col("scrubbed_species_binomial").alias("species")
    ).agg(F.max(F.coalesce("native_status", F.lit("absent"))).alias("nsr_native_status"))
    groups = lookup(spark, sf_dir, "range_model_data_metadata").select(
        F.col("scrubbed_species_binomial").alias("species"),
        F.col("filter_group").alias("filter.group"),
    )
    return pairs.join(groups, "species").select(
        "country", "species", "`filter.group`", "nsr_native_status"
    )


# --- The same views for DuckDB ---


def occ_sql() -> str:
    columns = ",\n".join(f'{sql} as "{name}"' for name, sql in OCC.items())
    helped = {
        table: "(select *, " + ", ".join(f"{sql} as {c}" for c, sql in added.items()) + f" from {table})"
        for table, added in HELPERS.items()
    }
    return f"""select {columns}
        from lineitem
        join orders on l_orderkey = o_orderkey
        join {helped["part"]} part on l_partkey = p_partkey
        join {helped["supplier"]} supplier on l_suppkey = s_suppkey
        join nation on s_nationkey = n_nationkey
        join region on n_regionkey = r_regionkey"""


def lookup_sql(name: str) -> str:
    table, columns, where = LOOKUPS[name]
    if name == "distribution":
        table = "lineitem join part on l_partkey = p_partkey"
    selected = ", ".join(f'{sql} as "{column}"' for column, sql in columns.items())
    return f"select {selected} from {table} where {where}"
