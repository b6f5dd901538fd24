"""Column lists of the crash tables (lower case, as the analyses use them).

Ids and codes are strings; the two count columns of ``units`` are cast to
numbers only where arithmetic needs them (see :func:`roadlens.functions.to_number`).
"""

from __future__ import annotations

PERSON_COLUMNS = [
    "crash_id", "unit_nbr", "prsn_nbr", "prsn_type_id", "prsn_gndr_id", "prsn_injry_sev_id",
    "prsn_airbag_id", "prsn_ethnicity_id", "drvr_lic_cls_id", "drvr_lic_state_id", "drvr_zip",
]

UNIT_COLUMNS = [
    "crash_id", "unit_nbr", "veh_hnr_fl", "veh_body_styl_id", "veh_make_id", "veh_color_id",
    "veh_lic_state_id", "tot_injry_cnt", "death_cnt", "contrib_factr_1_id", "contrib_factr_2_id",
    "contrib_factr_p1_id", "veh_dmag_scl_1_id", "veh_dmag_scl_2_id", "fin_resp_type_id",
]

DAMAGE_COLUMNS = ["crash_id", "damaged_property"]

CHARGE_COLUMNS = ["crash_id", "unit_nbr", "prsn_nbr", "charge"]

TABLE_COLUMNS = {
    "primary_person": PERSON_COLUMNS,
    "units": UNIT_COLUMNS,
    "damages": DAMAGE_COLUMNS,
    "charges": CHARGE_COLUMNS,
}

# Columns that hold whole numbers; typed reads cast them with try_cast.
COUNT_COLUMNS = {"units": ["tot_injry_cnt", "death_cnt"]}
