"""Fixed values of the published warehouse.

Results depend on these exact values, so they are stated here once, as plain
text, in their natural order. Besides a reader for the tables, nothing in this
module is logic.
"""

import csv
import io


def rows(text: str) -> list[dict[str, str]]:
    """The rows of one of the tables below."""
    return list(csv.DictReader(io.StringIO(text)))


# --- fixed values: metric dictionary (one row per published dataset) ---------
METRIC_DICTIONARY_CSV = """\
dataset_id,metric_group,metric_key,metric_name_uz,sex,settlement_type,measure_unit,unit_type
223,births,birth_total,tug'ilganlar jami,total,total,count,flow
224,births,birth_girls,tug'ilganlar qiz,female,total,count,flow
225,births,birth_boys,tug'ilganlar o'gil,male,total,count,flow
226,deaths,death_total,o'lganlar jami,total,total,count,flow
227,deaths,death_women,olganlar_ayol,female,total,count,flow
228,deaths,death_men,olganlar_erkak,male,total,count,flow
230,divorces,divorces_total,ajrashganlar_jami,total,total,count,flow
233,divorces,divorces_urban,ajrashganlar_shahar,total,urban,count,flow
232,divorces,divorces_rural,ajrashganlar_qishloq,total,rural,count,flow
268,migration,in_migration,kochib_kelganlar,total,total,count,flow
269,migration,out_migration,kochib_ketganlar,total,total,count,flow
238,migration,in_migration_total,kochib_kelganlar_jami,total,total,count,flow
239,migration,out_migration_total,kochib_kelganlar_jami,total,total,count,flow
243,marriages,marriages_total,nikoh_qurish_jami,total,total,count,flow
235,marriages,marriages_urban,nikoh_qurish_shahar,total,urban,count,flow
242,marriages,marriages_rural,nihoh_qurish_qishloq,total,rural,count,flow
244,population,population_women,doimiy_aholi_ayol,female,total,people,stock
245,population,population_men,doimiy_aholi_erkak,male,total,people,stock
246,population,population_total,doimiy_aholi_jami,total,total,people,stock
247,population,population_rural,doimiy_aholi_qishloq,total,rural,people,stock
248,population,population_urban,doimiy_aholi_shahar,total,urban,people,stock
"""

# --- fixed values: cleaned names for known geography codes -------------------
GEO_OVERRIDE_CSV = """\
geo_code,geo_name_clean
1714401,Namangan shahri
1714242,Yangiqo'rg'on tumani
1714237,Chust tumani
1714236,Chortoq tumani
1714234,Uchqo'rg'on tumani
1714229,Uychi tumani
1714224,To'raqo'rg'on tumani
1714219,Pop tumani
1714216,Norin tumani
1714212,Namangan tumani
1714207,Kosonsoy tumani
1714204,Mingbuloq tumani
1714,Namangan viloyati
"""

# --- fixed values: label dimensions ------------------------------------------
SEX_LABELS_CSV = """\
sex_id,sex_label_uz,sort_order
male,Erkak,1
female,Ayol,2
total,Jami,3
"""

SETTLEMENT_LABELS_CSV = """\
settlement_type_id,settlement_label_uz,sort_order
urban,Shahar,1
rural,Qishloq,2
total,Jami,3
"""

# --- fixed values: published datasets, years, scope --------------------------
CATALOGUED_DATASETS = [223, 224, 225, 226, 227, 228, 230, 232, 233, 235, 238, 239,
                       242, 243, 244, 245, 246, 247, 248, 268, 269]
UNSTAGED_DATASETS = [238, 239]  # catalogued only
STAGED_DATASETS = [223, 224, 225, 226, 227, 228, 230, 232, 233, 235,
                   242, 243, 244, 245, 246, 247, 248, 268, 269]
RAW_FILE_NAMING = "sdmx_data_{id}.csv"
RAW_FILE_ID_PATTERN = r"sdmx_data_(\d+)"
FIRST_YEAR, LAST_YEAR = 2010, 2024
DATASET_FIRST_YEAR = {244: 2014}
DEFAULT_GEO_PREFIX = "1714"

# --- fixed values: geography level patterns, first match wins ----------------
GEO_LEVEL_PATTERNS = [
    ("shahri", "shahar"),
    ("tumani", "tuman"),
    ("viloyati", "viloyat"),
    ("respublikasi", "respublika"),
]
GEO_LEVEL_UNKNOWN = "nomalum"

# --- fixed values: metric groups ---------------------------------------------
STOCK_GROUP = "population"
FLOW_GROUPS = ["births", "deaths", "migration", "marriages", "divorces"]
# The published flow model and its tests spell three groups differently from
# the dictionary; kept so that its literal result can be reproduced.
PUBLISHED_FLOW_GROUPS = ["birth", "death", "migration", "marriages", "divorce"]

# --- fixed values: mart measures ---------------------------------------------
OVERVIEW_MEASURES = ["population_total", "birth_total", "death_total", "in_migration",
                     "out_migration", "marriages_total", "divorces_total"]
POPULATION_MEASURES = ["population_total", "population_men", "population_women",
                       "population_urban", "population_rural"]
BIRTH_MEASURES = {"total_birth_yearly": "birth_total", "birth_girls": "birth_girls",
                  "birth_boys": "birth_boys"}

# --- fixed values: report columns --------------------------------------------
TREND_MEASURES = ["birth_total", "death_total", "net_migration"]
RANKING_COLUMNS = ["geo_name", "geo_code", "population_total", "birth_total", "death_total",
                   "natural_increase", "in_migration", "out_migration", "net_migration",
                   "cbr_per_1000", "cdr_per_1000", "net_mig_per_1000", "marriages_total",
                   "divorces_total"]
BIRTH_CHECK_COLUMNS = ["year", "total_birth_yearly", "birth_girls", "birth_boys", "sex_diff"]
