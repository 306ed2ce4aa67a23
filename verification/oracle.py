"""DuckDB SQL for every registered query."""

from __future__ import annotations

from occflow import constants as C
from verification import fixtures



def _listed(values: list[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _selected(columns: dict[str, str]) -> str:
    return ", ".join(source if source == name else f"{source} as {name}" for source, name in columns.items())


MAIN = f"""scrubbed_species_binomial is not null
    and higher_plant_group in ({_listed(C.PLANT_GROUPS)})
    and is_invalid_latlong = 0
    and is_geovalid = 1
    and (georef_protocol is null or georef_protocol <> '{C.EXCLUDED_GEOREF_PROTOCOL}')
    and (is_centroid is null or is_centroid = 0)
    and is_location_cultivated is null
    and (is_cultivated_observation = 0 or is_cultivated_observation is null)
    and observation_type in ({_listed(C.OBSERVATION_TYPES)})"""
DATED_OR_NULL = "(extract(year from event_date) >= 1950 or event_date is null)"
NATIVE = "is_introduced = 0"
NATIVE_OR_UNKNOWN = "(is_introduced = 0 or is_introduced is null)"
UNKNOWN = f"(native_status in ({_listed(C.UNKNOWN_STATUSES)}) or native_status is null)"

STANDARD = _selected(C.STANDARD_COLUMNS)
WIDE = _selected(C.UNFILTERED_COLUMNS)
VALIDATION = _selected(C.VALIDATION_COLUMNS)

IS_VASC = f"cast(case when higher_plant_group in ({_listed(C.VASCULAR_GROUPS)}) then 1 else 0 end as integer)"
YEAR = "cast(date_part('year', event_date) as integer)"
DECADE = f"cast(concat(left(cast({YEAR} as varchar), 3), '0') as integer)"


def extract(select: str, where: str) -> str:
    return f"""select * replace (case when taxonomic_status = 'No opinion' then 'Unresolved'
            else taxonomic_status end as taxonomic_status),
        replace(scrubbed_species_binomial, ' ', '_') as species_nospace,
        {IS_VASC} as is_vasc,
        {YEAR} as event_year,
        case when event_date is not null then {DECADE} end as decade
        from (select {select} from occ where {where})"""


def multistatus(observations: str) -> str:
    return f"""select scrubbed_species_binomial from (
        select distinct scrubbed_species_binomial, species_nospace, taxonomic_status
        from {observations}) group by 1 having count(*) > 1"""


def resolved(observations: str) -> str:
    return f"""select * from {observations} where not coalesce(
        taxonomic_status <> 'Accepted' and scrubbed_species_binomial in (
            {multistatus(observations)}), false)"""


def species_table(observations: str) -> str:
    return f"""select s.scrubbed_species_binomial, s.species_nospace, s.taxonomic_status,
        g.higher_plant_group, g.is_vasc, f.family, f.gf as growth_form
        from (select distinct scrubbed_species_binomial, species_nospace, taxonomic_status
            from {observations}) s
        left join (select *, row_number() over (partition by scrubbed_species_binomial
                order by higher_plant_group nulls last, is_vasc nulls last) as rn
            from (select distinct scrubbed_species_binomial, higher_plant_group, is_vasc
                from {observations})) g
            on s.scrubbed_species_binomial = g.scrubbed_species_binomial and g.rn = 1
        left join species_growth_forms f on s.scrubbed_species_binomial = f.species"""


def status_sets(where: str) -> str:
    return f"""select scrubbed_species_binomial,
        string_agg(distinct cast(is_introduced as varchar), ',' order by cast(is_introduced as varchar)) as is_introduced,
        string_agg(distinct scrubbed_taxonomic_status, ',' order by scrubbed_taxonomic_status) as taxonomic_status,
        string_agg(distinct native_status, ',' order by native_status) as native_status,
        count(*) as obs
        from occ where {where} group by 1"""


# Views by name; each may read those above it.
VIEWS = {
    "occ": fixtures.occ_sql(),
    **{name: fixtures.lookup_sql(name) for name in fixtures.LOOKUPS},
    "native0": extract(STANDARD, f"{MAIN} and {DATED_OR_NULL} and {NATIVE}"),
    "raw": resolved("native0"),
    "rms": species_table("raw"),
    "unknown0": extract(STANDARD, f"{MAIN} and {DATED_OR_NULL} and {UNKNOWN}"),
    "unknown1": resolved("unknown0"),
    "rms2": species_table("unknown1"),
    "sets": status_sets(f"{MAIN} and {DATED_OR_NULL}"),
    "native_status": """select scrubbed_species_binomial, is_introduced, native_status, obs,
        cast(case when scrubbed_species_binomial in (select scrubbed_species_binomial from rms)
            then 1 else 0 end as integer) as is_sdm_species from sets""",
    "rms2_flagged": f"""select r.*,
        scrubbed_species_binomial in (select scrubbed_species_binomial from rms) as shared,
        scrubbed_species_binomial not in (select scrubbed_species_binomial from native_status
            where native_status in ({_listed(C.UNLISTED_STATUS_SETS)}) or native_status is null) as listed
        from rms2 r""",
    "unshared_rms": "select * exclude (shared, listed) from rms2_flagged where not shared",
    "unshared_rmd": """select * from unknown1 where scrubbed_species_binomial not in (
        select scrubbed_species_binomial from rms2_flagged where shared)""",
    "final_rms": "select * exclude (shared, listed) from rms2_flagged where not shared and not listed",
    "final_rmd": """select * from unshared_rmd where scrubbed_species_binomial not in (
        select scrubbed_species_binomial from rms2_flagged where not shared and listed)""",
    "stats1": """select 1 as id, 'Before filtering multistatus species obs' as period,
            (select count(*) from native0) as obs,
            (select count(distinct scrubbed_species_binomial) from native0) as species,
            (select count(*) from (select distinct scrubbed_species_binomial, taxonomic_status from native0)) as species_table_rows
        union all select 2, 'After filtering multistatus species obs', (select count(*) from raw),
            (select count(distinct scrubbed_species_binomial) from rms), (select count(*) from rms)""",
    "stats_main": """select * from stats1 union all
        select 3, 'Difference', b.obs - a.obs, b.species - a.species, b.species_table_rows - a.species_table_rows
        from stats1 b, stats1 a where b.id = 1 and a.id = 2""",
    "stats2": """select 1 as id, 'Before filtering multistatus species obs' as period,
            (select count(*) from unknown0) as obs,
            (select count(distinct scrubbed_species_binomial) from unknown0) as species,
            (select count(*) from (select distinct scrubbed_species_binomial, taxonomic_status from unknown0)) as species_table_rows
        union all select 2, 'After filtering multistatus species obs', (select count(*) from unknown1),
            (select count(distinct scrubbed_species_binomial) from rms2), (select count(*) from rms2)""",
    "stats_supplemental": """select * from stats2
        union all select 3, 'Difference', b.obs - a.obs, b.species - a.species, b.species_table_rows - a.species_table_rows
            from stats2 b, stats2 a where b.id = 1 and a.id = 2
        union all select 4, 'Shared species', null, (select count(*) from rms2_flagged where shared), null
        union all select 5, 'After filtering shared species', (select count(*) from unshared_rmd),
            (select count(*) from unshared_rms), null
        union all select 6, 'NSR species', null, (select count(*) from rms2_flagged where not shared and listed), null
        union all select 7, 'After filtering NSR species', (select count(*) from final_rmd),
            (select count(*) from final_rms), null""",
    "any0": extract(STANDARD, f"{MAIN} and {DATED_OR_NULL}"),
    "legacy": extract(STANDARD, f"{MAIN} and {DATED_OR_NULL} and {NATIVE_OR_UNKNOWN}"),
    "legacy_rms": """select distinct scrubbed_species_binomial, species_nospace, taxonomic_status,
        higher_plant_group, is_vasc, f.family, f.gf as growth_form
        from legacy l left join species_growth_forms f on l.scrubbed_species_binomial = f.species""",
    "unfiltered": extract(WIDE, "true"),
    "test_data": f"select {VALIDATION} from occ where {MAIN} and {DATED_OR_NULL} and {NATIVE_OR_UNKNOWN}",
    "country_flags": f"""select country, iso_alpha3,
        cast(iso_alpha3 in ({_listed(C.CARIBBEAN)})
            as integer) as is_caribbean,
        cast(iso_alpha3 in ({_listed(C.LESSER_ANTILLES)}) as integer) as is_lesser_antilles,
        cast(0 as integer) as is_french_westindies from country""",
    "flagged_raw": f"""select b.*, case when taxonomic_status = 'Accepted' and is_introduced = 0
            then 1 else 0 end as is_range_model_ob_202209
        from (select a.*, {IS_VASC} as is_vasc from (
            select r.taxonobservation_id, r.scrubbed_species_binomial, r.latitude, r.longitude, r.country,
                r.observation_type, r.event_date, r.species_nospace, r.event_year, r.decade,
                o.native_status as native_status,
                case when o.taxonobservation_id is not null then o.is_introduced else 1 end as is_introduced,
                m.taxonomic_status as taxonomic_status, m.higher_plant_group as higher_plant_group
            from any0 r
            left join range_model_data_metadata m on r.scrubbed_species_binomial = m.scrubbed_species_binomial
            left join (select * from occ where scrubbed_species_binomial in (
                    select scrubbed_species_binomial from any0)
                qualify row_number() over (partition by taxonobservation_id
                    order by native_status nulls last, is_introduced nulls last) = 1) o
                on r.taxonobservation_id = o.taxonobservation_id) a) b""",
    "flagged_metadata": f"""select m.*, replace(scrubbed_species_binomial, ' ', '_') as species_nospace,
        {IS_VASC} as is_vasc,
        cast(scrubbed_species_binomial in (select scrubbed_species_binomial from flagged_raw
            where is_range_model_ob_202209 = 1) as integer) as is_range_model_species_202209
        from range_model_data_metadata m""",
    "backfilled": f"""select * exclude (year0) replace (cast(year0 as integer) as event_year,
            case when event_date is not null
            then cast(concat(left(cast(year0 as varchar), 3), '0') as integer) end as decade)
        from (select r.* replace (o.event_date as event_date), date_part('year', o.event_date) as year0
            from raw r left join (select * from occ where event_date is not null
                qualify row_number() over (partition by taxonobservation_id order by event_date) = 1) o
            on r.taxonobservation_id = o.taxonobservation_id)""",
    "profiled": """select s.*, cast(scrubbed_species_binomial in (
        select scrubbed_species_binomial from rms) as integer) as is_sdm_species from sets s""",
    "taxa": """select distinct scrubbed_family, scrubbed_species_binomial, scrubbed_taxon_name_no_author,
        scrubbed_author, scrubbed_taxonomic_status from occ where scrubbed_species_binomial in (
            select scrubbed_species_binomial from rms group by 1 having count(*) > 1)""",
    "rank_taxa": """select distinct scrubbed_family, scrubbed_species_binomial, scrubbed_taxon_name_no_author,
        scrubbed_taxonomic_status from taxa where scrubbed_species_binomial = scrubbed_taxon_name_no_author""",
    "listed": "select species from species_growth_forms where gf_conf_flag = 'low'",
    "country_species": """select country, species,
        cast(a.taxonomic_status = 'Accepted' as integer) as is_accepted, is_vascular,
        max(case when o.is_introduced = 0 then 1 else 0 end) as is_native
        from occ o join all_species a on o.scrubbed_species_binomial = a.species group by 1, 2, 3, 4""",
    "country_species_sdm": """select country, m.scrubbed_species_binomial as species, filter_group as "filter.group",
        max(coalesce(o.native_status, 'absent')) as nsr_native_status
        from occ o join range_model_data_metadata m using (scrubbed_species_binomial) group by 1, 2, 3""",
}

PERCENT = "cast(cast(floor((2000 * {n} + {t}) / (2 * {t})) as double) / 10 as decimal(4,1))"

POINTS = "taxonobservation_id, species_nospace as species, latitude, longitude"
ATTRIBUTES = """species_nospace as species, family, taxonomic_status, higher_plant_group, is_vasc, growth_form"""


def _null_rates(total_label: str, count: str, percent: str, measure: str) -> str:
    rows = " union ".join(
        f"select '{label}' as test, {measure} as n from test_data where {where}"
        for label, where in (
            (total_label, "true"),
            ("is_introduced_null", "is_introduced is null"),
            ("event_date_null", "event_date is null"),
        )
    )
    share = PERCENT.format(n="n", t="t")
    return f"""with counts as ({rows}) select test, n as "{count}", {share} as {percent}
        from counts, (select n as t from counts where test = '{total_label}')"""


def _where(condition: str) -> str:
    return f"select {STANDARD} from occ where {condition}"


VAL7_ROWS = """a.country, a.scrubbed_species_binomial as species, count(*) as observations
    from occ a join country b on a.country = b.country
    join raw c on a.taxonobservation_id = c.taxonobservation_id"""

QUERIES = {
    # Sources and sinks
    "src1_occurrences": "select * from occ",
    "src2_species_list": "select replace(species, ' ', '_') as species_ul from species_growth_forms",
    "src3_checklist": "select species from checklist_species",
    "src4_checklist_extract": "select distinct taxon as species from distribution where taxon_rank = 'species'",
    "snk1_run_table": "select * from native0",
    "snk4_species_list": "select distinct species_nospace from raw",
    "snk4_binomial_list": "select distinct scrubbed_species_binomial from raw",
    "snk5_roundtrip": f"select {POINTS}, species_nospace as species_file from raw",
    "snk6_headerless": f"select {POINTS}, species_nospace as species_file from legacy",
    "snk7_all_columns": """select *, species_nospace as species_file from unfiltered
        where species_nospace is not null""",
    "snk8_attributes": f"select {ATTRIBUTES} from rms",
    "snk9_metadata_attributes": """select species_nospace as species, family, filter_group, taxonomic_status,
        higher_plant_group, is_vasc, gf as growth_form from flagged_metadata
        where is_range_model_species_202209 = 1""",
    "snk11_dated_native": """select taxonobservation_id, species_nospace, decade from backfilled
        where taxonomic_status = 'Accepted' and is_introduced = 0""",
    "snk12_append_stats": "select * from stats_supplemental",
    # Derived columns
    "prj1_standard": f"select {STANDARD} from occ",
    "prj2_unfiltered": f"select {WIDE} from occ",
    "prj3_validation": f"select {VALIDATION} from occ",
    "prj4_nospace": """select taxonobservation_id, replace(scrubbed_species_binomial, ' ', '_') as species_nospace
        from occ""",
    "prj5_from_underscore": """select replace(species, ' ', '_') as species_ul, species
        from species_growth_forms""",
    "prj6_event_year": f"select taxonobservation_id, {YEAR} as event_year from occ",
    "prj7_decade": f"""select decade, count(*) as obs from (select case when event_date is not null
        then {DECADE} end as decade from occ) group by 1""",
    "prj8_is_vasc": f"select higher_plant_group, {IS_VASC} as is_vasc, count(*) as obs from occ group by 1, 2",
    "prj9_status": """select case when scrubbed_taxonomic_status = 'No opinion' then 'Unresolved'
        else scrubbed_taxonomic_status end as taxonomic_status, count(*) as obs from occ group by 1""",
    "prj10_obs_total": """select a.species, filter_group, case when filter_group = 'common' then "8. observation_type"
            when filter_group = 'rare' then "6. year>=1970" end as obs_total
        from all_species a left join range_model_data_metadata m on a.species = m.scrubbed_species_binomial
        left join species_observation_counts_crosstab c on a.species = c.species""",
    "prj11_obs_introduced": """select a.species, case when m.scrubbed_species_binomial is null then null
            when filter_group = 'common' then 0
            else "6. year>=1970" - "7. is_introduced" end as obs_introduced
        from all_species a left join range_model_data_metadata m on a.species = m.scrubbed_species_binomial
        left join species_observation_counts_crosstab c on a.species = c.species""",
    "prj12_caribbean": "select * from country_flags",
    "prj12_caribbean_fixed": f"""select * replace (
        cast(iso_alpha3 in ({_listed(C.FRENCH_WEST_INDIES)}) as integer) as is_french_westindies) from country_flags""",
    # Filters
    "flt1_quality": _where(f"{MAIN} and {DATED_OR_NULL}"),
    "flt2_native": _where(f"{MAIN} and {DATED_OR_NULL} and {NATIVE}"),
    "flt3_native_or_unknown": _where(f"{MAIN} and {DATED_OR_NULL} and {NATIVE_OR_UNKNOWN}"),
    "flt4_unknown_status": _where(f"{MAIN} and {DATED_OR_NULL} and {UNKNOWN}"),
    "flt5_introduced": _where(f"{MAIN} and {DATED_OR_NULL} and is_introduced = 1"),
    "flt6_strict_date": _where(f"{MAIN} and extract(year from event_date) >= 1950 and {NATIVE_OR_UNKNOWN}"),
    "flt7_dated_specimen": _where(
        f"""{MAIN} and {NATIVE_OR_UNKNOWN} and (extract(year from event_date) >= 1950
        or (event_date is null and observation_type <> 'specimen'))"""
    ),
    "flt8_unfiltered": _where("true"),
    "flt9_accepted_native": "select * from raw where taxonomic_status = 'Accepted' and is_introduced = 0",
    "flt12_clear_shared": "select * from stats_supplemental where period not like '%shared%'",
    "flt12_clear_checklist": "select * from stats_supplemental where period not like '%NSR%'",
    "flt13_species_rank": """select taxonobservation_id, scrubbed_taxon_name_no_author from occ
        where scrubbed_species_binomial = scrubbed_taxon_name_no_author""",
    "flt14_country_unknown": """select taxonobservation_id, country from occ
        where country is not null and native_status = 'UNK'""",
    "flt15_in_no_checklist": f"""select scrubbed_species_binomial, native_status from native_status
        where native_status in ({_listed(C.UNLISTED_STATUS_SETS)}) or native_status is null""",
    # Joins
    "jn1_group_attributes": "select scrubbed_species_binomial, taxonomic_status, higher_plant_group, is_vasc from rms",
    "jn2_growth_forms": "select scrubbed_species_binomial, taxonomic_status, family, growth_form from rms",
    "jn3_growth_form_confidence": """select a.species, f.gf as growth_form, gf_conf_flag as growth_form_conf
        from all_species a left join species_growth_forms f on a.species = f.species""",
    "jn4_filter_group": """select a.species, filter_group,
            case when m.scrubbed_species_binomial is null then 0 else 1 end as is_modelled
        from all_species a left join range_model_data_metadata m on a.species = m.scrubbed_species_binomial""",
    "jn5_filter_counts": """select a.species, "8. observation_type" as obs_common,
            "6. year>=1970" as obs_rare, "7. is_introduced" as obs_rare_native
        from all_species a left join species_observation_counts_crosstab c on a.species = c.species""",
    "jn6_metadata": """select taxonobservation_id, m.taxonomic_status, m.higher_plant_group
        from raw r left join range_model_data_metadata m using (scrubbed_species_binomial)""",
    "jn7_native_status": "select taxonobservation_id, native_status, is_introduced from flagged_raw",
    "jn8_dates": "select taxonobservation_id, event_date from backfilled",
    "jn9_species_attributes": """select scrubbed_species_binomial, scrubbed_taxonomic_status, higher_plant_group
        from (select *, row_number() over (partition by scrubbed_species_binomial
            order by scrubbed_taxonomic_status nulls last, higher_plant_group nulls last) as rn
            from occ where scrubbed_species_binomial in (select species from species_growth_forms))
        where rn = 1""",
    "jn10_is_sdm": "select * from native_status",
    "jn11_shared_flag": """select * exclude (shared, listed), cast(shared as integer) as is_in_run1
        from rms2_flagged""",
    "jn12_listed_flag": """select p.*, cast(scrubbed_species_binomial in (
        select species from checklist_species) as integer) as is_in_nsr from profiled p""",
    "jn13_checklist_flag": """select * exclude (shared, listed), cast(listed as integer) as is_in_nsr
        from rms2_flagged""",
    "jn14_metadata_flag": "select scrubbed_species_binomial, is_range_model_species_202209 from flagged_metadata",
    "jn15_resolved_rmd": "select * from raw",
    "jn18_multistatus_obs": """select taxonobservation_id, scrubbed_species_binomial, scrubbed_taxonomic_status
        from occ where scrubbed_species_binomial in (
            select scrubbed_species_binomial from rms group by 1 having count(*) > 1)""",
    # Aggregations
    "agg1_species_status": "select distinct scrubbed_species_binomial, species_nospace, taxonomic_status from native0",
    "agg2_multistatus": multistatus("native0"),
    "agg3_species_groups": "select distinct scrubbed_species_binomial, higher_plant_group, is_vasc from raw",
    "agg4_species_by_group": """select distinct scrubbed_species_binomial, species_nospace, taxonomic_status,
        higher_plant_group, is_vasc from legacy""",
    "agg5_native_status": "select scrubbed_species_binomial, is_introduced, native_status, obs from sets",
    "agg5_taxonomic_status": "select * from sets",
    "agg6_counts": "select * from stats1 where id = 1",
    "agg7_difference": "select * from stats_main where id = 3",
    "agg8_supplemental_rows": "select * from stats_supplemental where id >= 4",
    "agg9_unique": """select exists (select 1 from (select * from rms union all select * from final_rms)
        group by scrubbed_species_binomial having count(*) > 1) as has_non_unique_species""",
    # Jobs
    "job1_extract_native": "select * from native0",
    "job1_limited": "select * from native0 order by taxonobservation_id limit 1000",
    "job3_species_table": "select * from rms",
    "stats_main": "select * from stats_main",
    "job4_native_status": "select * from native_status",
    "job4_limited": f"""with limited as (select * from occ where {MAIN} and {DATED_OR_NULL}
            order by taxonobservation_id limit 1000)
        select scrubbed_species_binomial,
            string_agg(distinct cast(is_introduced as varchar), ',' order by cast(is_introduced as varchar)) as is_introduced,
            string_agg(distinct native_status, ',' order by native_status) as native_status,
            count(*) as obs from limited group by 1""",
    "job5_after_shared_rmd": "select * from unshared_rmd",
    "job5_after_shared_rms": "select * from unshared_rms",
    "job6_final_rmd": "select * from final_rmd",
    "job6_final_rms": "select * from final_rms",
    "stats_supplemental": "select * from stats_supplemental",
    "job8_main_rmd": "select * from raw",
    "job8_main_rms": "select * from rms",
    "job9_supplemental_rmd": "select * from final_rmd",
    "job10_unfiltered": "select * from unfiltered",
    "job11_import": """select replace(l.species, ' ', '_') as species_ul, l.species,
            o.scrubbed_taxonomic_status as taxonomic_status, o.higher_plant_group as higher_taxon
        from (select species from species_growth_forms union all select 'absent one'
            union all select 'absent two') l
        left join (select *, row_number() over (partition by scrubbed_species_binomial
            order by scrubbed_taxonomic_status nulls last, higher_plant_group nulls last) as rn from occ) o
            on l.species = o.scrubbed_species_binomial and o.rn = 1""",
    "job12_flags": "select * from flagged_raw",
    "job12_metadata": "select * from flagged_metadata",
    "job13_legacy_rmd": "select * from legacy",
    "job13_legacy_rms": "select * from legacy_rms",
    "job14_introduced": """select a.species, a.genus, a.family, f.gf as growth_form, f.gf_conf_flag as growth_form_conf,
            a.taxonomic_status, a.higher_plant_group, a.is_vascular, m.filter_group,
            case when m.filter_group = 'common' then c."8. observation_type"
                when m.filter_group = 'rare' then c."6. year>=1970" end as obs_total,
            case when m.filter_group = 'common' then 0
                else c."6. year>=1970" - c."7. is_introduced" end as obs_introduced
        from all_species a join range_model_data_metadata m on a.species = m.scrubbed_species_binomial
        left join species_growth_forms f on a.species = f.species
        left join species_observation_counts_crosstab c on a.species = c.species
        where a.taxonomic_status = 'Accepted'""",
    "job15_combined": "select * from rms union all select * from final_rms",
    "job16_sample": "select * from raw order by taxonobservation_id limit 100",
    "job16_sample_metadata": """select distinct m.* from range_model_data_metadata m
        where scrubbed_species_binomial in (select scrubbed_species_binomial from
            (select * from raw order by taxonobservation_id limit 100))""",
    # Validations
    "val1_decade": "select decade, count(*) as raw_obs from backfilled group by 1",
    "val1_species_decade": """select scrubbed_species_binomial as species, taxonomic_status, decade,
        count(*) as raw_obs from backfilled where is_introduced = 0 or is_introduced is null group by 1, 2, 3""",
    "val2_null_obs": _null_rates("total_obs", "rows", "perc_obs", "count(*)"),
    "val2_null_spp": _null_rates(
        "total_spp", "species", "perc_spp", "count(distinct scrubbed_species_binomial)"
    ),
    "val2_country": "select country, count(*) as obs from test_data where is_introduced is null group by 1",
    "val2_dataset": """select datasource, dataset, count(*) as "count" from test_data
        where event_date is null and observation_type = 'plot' group by 1, 2""",
    "val2_obs_type": f"""select observation_type, n as "rows", {PERCENT.format(n='n', t='1000000')} as prop_rows
        from (select observation_type, count(*) as n from test_data where event_date is null group by 1)""",
    "val2_peek": """select observation_type, datasource, dataset, scrubbed_family, scrubbed_species_binomial,
        country, is_introduced, event_date_verbatim, date_collected_verbatim
        from (select * from test_data where event_date is null order by taxonobservation_id limit 12)""",
    "val3_region_flags": "select * from country_flags",
    "val4_overlap": """select 1 as id, 'Before: shared species' as period, cast(null as bigint) as obs,
            (select count(*) from rms2_flagged where shared) as species, cast(null as bigint) as species_table_rows
        union all select 2, 'Before filtering shared species', (select count(*) from unknown1),
            (select count(*) from rms2), null
        union all select 3, 'After: shared species', null, (select count(*) from unshared_rms
            where scrubbed_species_binomial in (select scrubbed_species_binomial from rms)), null
        union all select 4, 'After filtering shared species', (select count(*) from unshared_rmd),
            (select count(*) from unshared_rms), null""",
    "val5_native": """select is_sdm_species, is_introduced, native_status, cast(sum(obs) as bigint) as obs,
        count(*) as species from profiled group by 1, 2, 3""",
    "val5_taxonomic": """select taxonomic_status, cast(sum(obs) as bigint) as obs, count(*) as species
        from profiled where is_sdm_species = 0 group by 1""",
    "val5_nsr": """select cast(scrubbed_species_binomial in (select species from checklist_species) as integer) as is_in_nsr,
        native_status, cast(sum(obs) as bigint) as obs, count(*) as species
        from profiled where is_sdm_species = 0 group by 1, 2""",
    "val5_country": """select country, count(*) as obs, count(distinct scrubbed_species_binomial) as species
        from occ where country is not null and native_status = 'UNK' group by 1""",
    "val6_species_rank": "select * from rank_taxa",
    "val6_conflicting": """select a.* from taxa a join (select scrubbed_species_binomial from rank_taxa
        group by 1 having count(*) > 1) b using (scrubbed_species_binomial)""",
    "val7a_species_counts": """select scrubbed_species_binomial as species, count(*) as observations from raw
        where scrubbed_species_binomial in (select species from listed) group by 1""",
    "val7b_country": """select a.taxonobservation_id, a.scrubbed_species_binomial as species, a.latitude, a.longitude
        from raw a join occ b on a.taxonobservation_id = b.taxonobservation_id
        where b.country = 'NATION_3' and a.scrubbed_species_binomial in (select species from listed)""",
    "val7c_continent": """select a.taxonobservation_id, a.scrubbed_species_binomial as species, b.country,
            a.latitude, a.longitude, b.is_geovalid, b.is_cultivated_observation as is_cult, b.is_introduced
        from raw a join occ b on a.taxonobservation_id = b.taxonobservation_id
        where b.continent = 'EUROPE' and (a.scrubbed_species_binomial like 'hot%'
            or a.scrubbed_species_binomial like 'blue%')""",
    "val7d_locality": """select a.taxonobservation_id, a.scrubbed_species_binomial as species, b.country, b.locality
        from raw a join occ b on a.taxonobservation_id = b.taxonobservation_id
        where b.continent = 'EUROPE' and (a.scrubbed_species_binomial like 'hot%'
            or a.scrubbed_species_binomial like 'blue%')""",
    "val7e_genus": """select country, scrubbed_species_binomial as species, latitude, longitude, is_geovalid,
            is_centroid, is_cultivated_observation as is_cult, is_introduced,
            left(locality, 50) as locality_description
        from occ where country = 'NATION_3' and scrubbed_genus in ('hot', 'blue')""",
    "val7f_genus_in_raw": """select a.country, a.scrubbed_species_binomial as species, is_geovalid, is_centroid,
            is_cultivated_observation as is_cult, a.is_introduced
        from occ a join raw b on a.taxonobservation_id = b.taxonobservation_id
        where a.country = 'NATION_3' and scrubbed_genus in ('hot', 'blue')""",
    "val7g_territory_species": f"""select distinct scrubbed_species_binomial as species
        from occ a join country b on a.country = b.country
        where b.iso_alpha3 in ({_listed([*C.FRENCH_WEST_INDIES, 'GUF'])})
            and scrubbed_species_binomial in (select species from listed)""",
    "val7h_region_flag": """select distinct scrubbed_species_binomial as species
        from occ a join country_flags b on a.country = b.country
        where (b.is_caribbean = 1 or b.iso_alpha3 = 'GUF')
            and scrubbed_species_binomial in (select species from listed)""",
    "val7i_territory_rows": f"""select taxonobservation_id, scrubbed_species_binomial as species, a.country, is_geovalid,
            is_cultivated_observation as is_cult, a.is_introduced
        from occ a join country b on a.country = b.country
        where b.iso_alpha3 in ({_listed(C.FRENCH_WEST_INDIES)})
            and scrubbed_species_binomial in (select species from listed)""",
    "val7j_species_country": f"""select {VAL7_ROWS} where b.iso_alpha3 in ({_listed([*C.FRENCH_WEST_INDIES, 'GUF'])})
        and a.scrubbed_species_binomial in (select species from listed) group by 1, 2""",
    "val7j_wider": f"""select {VAL7_ROWS} where b.iso_alpha3 in ({_listed([*C.FRENCH_WEST_INDIES, 'GUF', 'PYF', 'ATF'])})
        and a.scrubbed_species_binomial in (select species from listed) group by 1, 2""",
    "val7k_one_species": f"""select {VAL7_ROWS} where a.scrubbed_species_binomial = 'hot gear 3' group by 1, 2""",
    "val8_prefix": """select * from country_species where country = 'NATION_3'
        and (species like 'hot%' or species like 'blue%')""",
    "val8_prefix_sdm": """select * from country_species_sdm where country = 'NATION_3'
        and (species like 'hot%' or species like 'blue%')""",
}


def _needed(sql: str) -> list[str]:
    """Names of the views that ``sql`` reads, itself or through others, in order."""
    import re

    words = set(re.findall(r"\w+", sql))
    for name in reversed(VIEWS):
        if name in words:
            words |= set(re.findall(r"\w+", VIEWS[name]))
    return [name for name in VIEWS if name in words]


# Whole jobs give what their parts give.
QUERIES |= {
    "job8_extended_rmd": QUERIES["job8_main_rmd"],
    "job8_extended_rms": QUERIES["job8_main_rms"],
    "stats_extended": QUERIES["stats_main"],
    "snk2_catalog": "select * from species_growth_forms",
    "snk3_refused": "select distinct species_nospace as species_ul, true as refused from raw",
    "snk5_manifest": """select species_nospace as species_file, count(*) as rows from raw
        where species_nospace is not null group by 1""",
    "snk5_resumed": QUERIES["snk5_roundtrip"],
    "snk12_appended_twice": QUERIES["stats_main"],
    "srt1_species_list": """select species_nospace, row_number() over (order by species_nospace nulls last) as position
        from (select distinct species_nospace from raw)""",
    "srt1_attributes": """select species_nospace as species, row_number() over (order by species_nospace nulls last) as position
        from rms""",
    "srt2_decades": """select *, row_number() over (order by decade desc nulls first) as position
        from (select decade, count(*) as raw_obs from backfilled group by 1)""",
    "lim1_large": f"select {STANDARD} from occ where {MAIN} and {DATED_OR_NULL} and {NATIVE} order by taxonobservation_id limit 1000",
    "job7_export": QUERIES["snk5_roundtrip"],
    "job9_supplemental_rms": QUERIES["job6_final_rms"],
    "job9_native_status": QUERIES["job4_native_status"],
    "job10_export": QUERIES["snk7_all_columns"],
    "job12_export": f"""select {POINTS}, species_nospace as species_file from flagged_raw
        where is_range_model_ob_202209 = 1""",
    "job13_export": QUERIES["snk6_headerless"],
    "job14_export": QUERIES["job14_introduced"],
    "job15_export": QUERIES["job15_combined"],
}


def oracle_sql() -> dict[str, str]:
    out = {}
    for name, sql in QUERIES.items():
        views = ",\n".join(f"{v} as materialized ({VIEWS[v]})" for v in _needed(sql))
        out[name] = f"with {views}\nselect * from ({sql})" if views else sql
    return out
