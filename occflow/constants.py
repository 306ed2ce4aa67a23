"""Column names used throughout, and the fixed values of the curation rules."""

SPECIES = "scrubbed_species_binomial"
NOSPACE = "species_nospace"
STATUS = "taxonomic_status"
GROUP = "higher_plant_group"
IS_VASC = "is_vasc"
OBS_ID = "taxonobservation_id"

# --- Fixed values: results depend on these exact lists and strings. ---

PLANT_GROUPS = [
    "bryophytes",
    "ferns and allies",
    "flowering plants",
    "gymnosperms (conifers)",
    "gymnosperms (non-conifer)",
]

VASCULAR_GROUPS = [
    "ferns and allies",
    "flowering plants",
    "gymnosperms (conifers)",
    "gymnosperms (non-conifer)",
]

OBSERVATION_TYPES = ["plot", "specimen", "literature", "checklist"]

FIRST_YEAR_START = "1950-01-01"

EXCLUDED_GEOREF_PROTOCOL = "county_centroid"

# Native-status values of observations whose status is not known.
UNKNOWN_STATUSES = ["A", "UNK"]

# Joined native-status sets of species that appear in no checklist.
UNLISTED_STATUS_SETS = ["A", "A,UNK", "UNK"]

ACCEPTED = "Accepted"
UNRESOLVED = "Unresolved"
NO_OPINION = "No opinion"

# ISO 3166-1 alpha-3 codes.
CARIBBEAN = [
    "AIA", "ATG", "ABW", "BHS", "BRB", "BMU", "BES", "VGB", "CYM", "CUB",
    "CUW", "DMA", "DOM", "GRD", "GLP", "HTI", "JAM", "MTQ", "MSR", "PRI",
    "BLM", "KNA", "LCA", "MAF", "VCT", "SXM", "TTO", "TCA", "VIR",
]

LESSER_ANTILLES = [
    "AIA", "ATG", "ABW", "BRB", "BES", "VGB", "CUW", "DMA", "GLP", "MTQ",
    "MSR", "PRI", "BLM", "KNA", "LCA", "MAF", "VCT", "SXM", "TTO", "VIR",
]

FRENCH_WEST_INDIES = ["GLP", "MTQ", "BLM", "MAF"]

# Columns of an occurrence extract, source name -> output name.
STANDARD_COLUMNS = {
    "taxonobservation_id": "taxonobservation_id",
    "scrubbed_species_binomial": "scrubbed_species_binomial",
    "latitude": "latitude",
    "longitude": "longitude",
    "scrubbed_taxonomic_status": "taxonomic_status",
    "higher_plant_group": "higher_plant_group",
    "country": "country",
    "native_status": "native_status",
    "is_introduced": "is_introduced",
    "observation_type": "observation_type",
    "event_date": "event_date",
}

# Columns that an occurrence table must have, with their types. It may have others.
OCCURRENCE_SCHEMA = """
    taxonobservation_id bigint, scrubbed_species_binomial string, latitude double, longitude double,
    scrubbed_taxonomic_status string, higher_plant_group string, country string, native_status string,
    is_introduced int, observation_type string, event_date date, is_invalid_latlong int, is_geovalid int,
    georef_protocol string, is_centroid int, is_location_cultivated int, is_cultivated_observation int
"""

UNFILTERED_COLUMNS = {
    "taxonobservation_id": "taxonobservation_id",
    "observation_type": "observation_type",
    "datasource": "datasource",
    "dataset": "dataset",
    "datasetkey": "datasetkey",
    "fk_tnrs_id": "fk_tnrs_id",
    "verbatim_scientific_name": "verbatim_scientific_name",
    "name_matched": "name_matched",
    "name_matched_author": "name_matched_author",
    "matched_taxonomic_status": "matched_taxonomic_status",
    "scrubbed_species_binomial": "scrubbed_species_binomial",
    "scrubbed_taxon_name_no_author": "scrubbed_taxon_name_no_author",
    "scrubbed_author": "scrubbed_author",
    "scrubbed_taxonomic_status": "taxonomic_status",
    "higher_plant_group": "higher_plant_group",
    "latitude": "latitude",
    "longitude": "longitude",
    "is_invalid_latlong": "is_invalid_latlong",
    "invalid_latlong_reason": "invalid_latlong_reason",
    "fk_gnrs_id": "fk_gnrs_id",
    "country": "country",
    "is_geovalid": "is_geovalid",
    "fk_cds_id": "fk_cds_id",
    "is_centroid": "is_centroid",
    "georef_protocol": "georef_protocol",
    "nsr_id": "nsr_id",
    "is_location_cultivated": "is_location_cultivated",
    "is_cultivated_observation": "is_cultivated_observation",
    "native_status": "native_status",
    "is_introduced": "is_introduced",
    "event_date": "event_date",
}

VALIDATION_COLUMNS = {
    "taxonobservation_id": "taxonobservation_id",
    "observation_type": "observation_type",
    "datasource": "datasource",
    "dataset": "dataset",
    "scrubbed_family": "scrubbed_family",
    "scrubbed_species_binomial": "scrubbed_species_binomial",
    "country": "country",
    "is_introduced": "is_introduced",
    "event_date": "event_date",
    "event_date_verbatim": "event_date_verbatim",
    "date_collected_verbatim": "date_collected_verbatim",
}

# Labels of the run statistics.
BEFORE_MULTISTATUS = "Before filtering multistatus species obs"
AFTER_MULTISTATUS = "After filtering multistatus species obs"
DIFFERENCE = "Difference"
SHARED_SPECIES = "Shared species"
AFTER_SHARED = "After filtering shared species"
CHECKLIST_SPECIES = "NSR species"
AFTER_CHECKLIST = "After filtering NSR species"
OVERLAP_BEFORE = "Before: shared species"
OVERLAP_BEFORE_FILTER = "Before filtering shared species"
OVERLAP_AFTER = "After: shared species"

# --- End of fixed values. ---
