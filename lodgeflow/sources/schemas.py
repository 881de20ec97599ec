"""Bronze table schemas and dimension file routing.

Bronze keeps every incoming column as text (dates deliberately so), in the
fixed column order of the raw layer.
"""

from __future__ import annotations

from pyspark.sql import types as T

from lodgeflow.sources.driver_tables import AGE_BANDS

# The raw listing table's columns, in table order.
LISTING_COLUMNS = (
    "LISTING_ID", "SCRAPE_ID", "SCRAPED_DATE", "HOST_ID", "HOST_NAME", "HOST_SINCE",
    "HOST_IS_SUPERHOST", "HOST_NEIGHBOURHOOD", "LISTING_NEIGHBOURHOOD", "PROPERTY_TYPE",
    "ROOM_TYPE", "ACCOMMODATES", "PRICE", "HAS_AVAILABILITY", "AVAILABILITY_30",
    "NUMBER_OF_REVIEWS", "REVIEW_SCORES_RATING", "REVIEW_SCORES_ACCURACY",
    "REVIEW_SCORES_CLEANLINESS", "REVIEW_SCORES_CHECKIN", "REVIEW_SCORES_COMMUNICATION",
    "REVIEW_SCORES_VALUE", "MONTH_YEAR",
)
# Census G01 measures after the age bands; each comes as _M, _F, _P.
G01_OTHER_MEASURES = (
    "Counted_Census_Night_home", "Count_Census_Nt_Ewhere_Aust", "Indigenous_psns_Aboriginal",
    "Indig_psns_Torres_Strait_Is", "Indig_Bth_Abor_Torres_St_Is", "Indigenous_P_Tot",
    "Birthplace_Australia", "Birthplace_Elsewhere", "Lang_spoken_home_Eng_only",
    "Lang_spoken_home_Oth_Lang", "Australian_citizen", "Age_psns_att_educ_inst_0_4",
    "Age_psns_att_educ_inst_5_14", "Age_psns_att_edu_inst_15_19", "Age_psns_att_edu_inst_20_24",
    "Age_psns_att_edu_inst_25_ov", "High_yr_schl_comp_Yr_12_eq", "High_yr_schl_comp_Yr_11_eq",
    "High_yr_schl_comp_Yr_10_eq", "High_yr_schl_comp_Yr_9_eq", "High_yr_schl_comp_Yr_8_belw",
    "High_yr_schl_comp_D_n_g_sch", "Count_psns_occ_priv_dwgs", "Count_Persons_other_dwgs",
)
# Census G02 measures.
G02_COLUMNS = (
    "Median_age_persons", "Median_mortgage_repay_monthly", "Median_tot_prsnl_inc_weekly",
    "Median_rent_weekly", "Median_tot_fam_inc_weekly", "Average_num_psns_per_bedroom",
    "Median_tot_hhd_inc_weekly", "Average_household_size",
)


def text_schema(columns) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


LISTING_SCHEMA = text_schema(LISTING_COLUMNS)
LGA_CODE_SCHEMA = text_schema(("LGA_CODE", "LGA_NAME"))
LGA_SUBURB_SCHEMA = text_schema(("LGA_NAME", "SUBURB_NAME"))
G01_SCHEMA = text_schema(("LGA_CODE_2016",) + tuple(
    f"{p}_{s}" for p in ("Tot_P",) + AGE_BANDS + G01_OTHER_MEASURES for s in ("M", "F", "P")))
G02_SCHEMA = text_schema(("LGA_CODE_2016",) + G02_COLUMNS)

# A3: dimension file name -> (bronze table, schema, keep only the first N columns).
DIM_SPECS = {
    "2016Census_G01_NSW_LGA.csv": ("r_d_2016census_g01_nsw_lga", G01_SCHEMA, None),
    "2016Census_G02_NSW_LGA.csv": ("r_d_2016census_g02_nsw_lga", G02_SCHEMA, None),
    "NSW_LGA_CODE.csv": ("r_d_nsw_lga_code", LGA_CODE_SCHEMA, 2),
    "NSW_LGA_SUBURB.csv": ("r_d_nsw_lga_suburb", LGA_SUBURB_SCHEMA, 2),
}
FACT_TABLE = "r_f_listing"
# The raw listing table's primary key.
FACT_KEYS = ("LISTING_ID", "SCRAPED_DATE")
# Accepted month file names, MM_2020.csv for 01-12 and MM_2021.csv for 01-04.
FACT_FILE_PATTERN = r"^(0[1-9]|1[0-2])_2020\.csv$|^(0[1-4])_2021\.csv$"
