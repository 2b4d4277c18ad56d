"""Plain-dict configurations.

Operators never read configuration at import time; jobs receive one of these
mappings (or a user's own with the same keys) as an argument.

* ``ORDER_FEATURES`` runs the whole flow on the driver's ``order_features`` view.
* ``housing_config()`` carries the reference's own settings for its house-price
  table, so a user of the reference can run the same job on the same CSV.
"""

from __future__ import annotations

from .functions.columns import snake_name

# ---------------------------------------------------------------------------
# Generic configuration for the order_features view (driver test tables).
# ---------------------------------------------------------------------------

ORDER_FEATURES: dict = {
    "key": "o_orderkey",
    "target": "o_totalprice",
    "data_split": {"train": 0.6, "valid": 0.2, "test": 0.2, "random_state": 42},
    "model": {"active": "linear_regression"},
    "selection": {"k": 6},
    "metrics": ["MSE", "RMSE", "MAE", "r2"],
    "features": {
        "continuous": ["c_acctbal", "lines_qty", "lines_value"],
        "categorical": ["o_orderpriority", "o_orderstatus", "c_mktsegment"],
        "ordinal": ["lines_cnt", "order_year"],
        "engineered": ["ship_lag", "value_and_balance"],
        "most_relevant_features": ["c_mktsegment"],
    },
    "engineering": [
        {"name": "ship_lag", "minus": ["last_ship_year", "order_year"]},
        {"name": "value_and_balance", "weights": {"lines_value": 1, "c_acctbal": 0.5}},
    ],
    "preprocessing": {
        "rename_columns": {},
        "drop_columns": [],
        "fillna": {"numerical_zero": ["lines_qty", "lines_cnt"], "categorical_none": ["c_mktsegment"]},
        "fillna_groupby": {"column": "lines_value", "groupby": "n_name", "method": "mean"},
        "dropna_rows": ["last_ship_year"],
        "encoding": {"one_hot": {"apply_to": "categorical", "drop": "first", "handle_unknown": "ignore"}},
        "scaling": {"method": "standard", "apply_to": ["continuous", "ordinal"]},
    },
    "data_validation": {
        "enabled": True,
        "action_on_error": "warn",
        "schema": {"columns": [
            {"name": "o_orderkey", "dtype": "int", "required": True},
            {"name": "o_custkey", "dtype": "int", "required": True},
            {"name": "o_orderstatus", "dtype": "str", "required": True},
            {"name": "o_totalprice", "dtype": "float", "required": True},
            {"name": "o_orderpriority", "dtype": "str", "required": True},
            {"name": "c_acctbal", "dtype": "float", "required": True},
            {"name": "c_mktsegment", "dtype": "str"},
            {"name": "lines_cnt", "dtype": "int"},
            {"name": "o_comment", "dtype": "str"},
        ]},
    },
}

# ---------------------------------------------------------------------------
# The reference's settings for its house-price table.
# Column names, types, roles and lists must equal the reference's for the same
# results on the same data; they are listed as given there.
# ---------------------------------------------------------------------------

HOUSING_INT_COLUMNS = [
    "PID", "Low Qual Fin SF", "Gr Liv Area", "Full Bath", "Half Bath", "Bedroom AbvGr",
    "Kitchen AbvGr", "TotRms AbvGrd", "Fireplaces", "Wood Deck SF", "Open Porch SF",
    "Enclosed Porch", "3Ssn Porch", "Screen Porch", "Pool Area", "Misc Val", "Mo Sold",
    "Yr Sold", "2nd Flr SF", "1st Flr SF", "SalePrice", "Lot Area", "Overall Cond",
    "MS SubClass", "Overall Qual", "Year Remod/Add", "Year Built",
]
HOUSING_FLOAT_COLUMNS = [
    "Bsmt Unf SF", "BsmtFin SF 2", "BsmtFin SF 1", "Garage Area", "Bsmt Full Bath",
    "Total Bsmt SF", "Garage Cars", "Mas Vnr Area", "Lot Frontage", "Garage Yr Blt",
    "Bsmt Half Bath",
]
HOUSING_STR_COLUMNS = [
    "Garage Finish", "Garage Type", "Garage Qual", "Roof Style", "Paved Drive", "Utilities",
    "Fireplace Qu", "Land Contour", "Lot Shape", "Alley", "Street", "Pool QC", "Fence",
    "Misc Feature", "MS Zoning", "Sale Type", "Garage Cond", "Lot Config", "Condition 2",
    "Land Slope", "Roof Matl", "Exterior 1st", "Exterior 2nd", "Mas Vnr Type", "Exter Qual",
    "Exter Cond", "Foundation", "Bsmt Qual", "Bsmt Cond", "Bsmt Exposure", "BsmtFin Type 1",
    "BsmtFin Type 2", "Heating", "Sale Condition", "Central Air", "Electrical", "House Style",
    "Bldg Type", "Condition 1", "Neighborhood", "Kitchen Qual", "Functional", "Heating QC",
]

# Fields of the single-record scoring contract and their types: 16 required, 55 optional.
HOUSING_RECORD_REQUIRED = {
    "Overall Qual": "int", "Gr Liv Area": "float", "Garage Cars": "int", "Kitchen Qual": "str",
    "Exter Qual": "str", "Neighborhood": "str", "Bsmt Full Bath": "int", "Bsmt Half Bath": "int",
    "Full Bath": "int", "Half Bath": "int", "1st Flr SF": "int", "2nd Flr SF": "int",
    "Total Bsmt SF": "float", "Year Built": "int", "Year Remod/Add": "int", "Yr Sold": "int",
}
HOUSING_RECORD_OPTIONAL = {
    "MS Zoning": "str", "Street": "str", "Lot Shape": "str", "Land Contour": "str", "Utilities": "str",
    "Lot Config": "str", "Land Slope": "str", "Condition 1": "str", "Condition 2": "str",
    "Bldg Type": "str", "House Style": "str", "Overall Cond": "int", "Roof Style": "str",
    "Roof Matl": "str", "Exterior 1st": "str", "Exterior 2nd": "str", "Mas Vnr Type": "str",
    "Mas Vnr Area": "float", "Exter Cond": "str", "Foundation": "str", "Bsmt Qual": "str",
    "Bsmt Cond": "str", "Bsmt Exposure": "str", "BsmtFin Type 1": "str", "BsmtFin SF 1": "float",
    "BsmtFin Type 2": "str", "BsmtFin SF 2": "float", "Bsmt Unf SF": "float", "Heating": "str",
    "Heating QC": "str", "Central Air": "str", "Electrical": "str", "Kitchen AbvGr": "int",
    "TotRms AbvGr": "int", "Functional": "str", "Fireplaces": "int", "Fireplace Qu": "str",
    "Garage Type": "str", "Garage Yr Blt": "float", "Garage Finish": "str", "Garage Area": "float",
    "Garage Qual": "str", "Garage Cond": "str", "Paved Drive": "str", "Wood Deck SF": "float",
    "Open Porch SF": "float", "Enclosed Porch": "float", "3Ssn Porch": "float", "Screen Porch": "float",
    "Pool Area": "float", "Sale Type": "str", "Sale Condition": "str", "Bedroom AbvGr": "int",
    "Lot Area": "int", "Low Qual Fin SF": "int",
}

HOUSING_FEATURES = {
    "continuous": [
        "lot_area", "year_built", "year_remod_add", "mas_vnr_area", "bsmtfin_sf_1", "bsmtfin_sf_2",
        "bsmt_unf_sf", "total_bsmt_sf", "1st_flr_sf", "2nd_flr_sf", "low_qual_fin_sf",
        "gr_liv_area", "garage_area", "wood_deck_sf", "open_porch_sf", "enclosed_porch",
        "3ssn_porch", "screen_porch", "garage_yr_blt", "pool_area",
    ],
    "categorical": [
        "ms_subclass", "ms_zoning", "street", "lot_shape", "land_contour", "utilities",
        "lot_config", "land_slope", "neighborhood", "condition_1", "condition_2", "bldg_type",
        "house_style", "roof_style", "roof_matl", "exterior_1st", "exterior_2nd", "mas_vnr_type",
        "exter_qual", "exter_cond", "foundation", "bsmt_qual", "bsmt_cond", "bsmt_exposure",
        "bsmtfin_type_1", "bsmtfin_type_2", "heating", "heating_qc", "central_air", "electrical",
        "kitchen_qual", "functional", "fireplace_qu", "garage_type", "garage_finish",
        "garage_qual", "garage_cond", "paved_drive", "sale_type", "sale_condition",
    ],
    "ordinal": [
        "overall_qual", "overall_cond", "garage_cars", "full_bath", "half_bath", "totrms_abvgr",
        "bedroom_abvgr", "kitchen_abvgr", "bsmt_full_bath", "bsmt_half_bath", "fireplaces",
        "yr_sold",
    ],
    "engineered": ["total_sf", "bathrooms", "house_age", "since_remodel"],
    "most_relevant_features": [
        "overall_qual", "garage_cars", "gr_liv_area", "kitchen_qual", "exter_qual", "neighborhood",
    ],
}

HOUSING_ENGINEERING = [
    {"name": "total_sf", "weights": {"1st Flr SF": 1, "2nd Flr SF": 1, "Total Bsmt SF": 1}},
    {"name": "bathrooms",
     "weights": {"Full Bath": 1, "Half Bath": 0.5, "Bsmt Full Bath": 1, "Bsmt Half Bath": 0.5}},
    {"name": "house_age", "minus": ["Yr Sold", "Year Built"]},
    {"name": "since_remodel", "minus": ["Yr Sold", "Year Remod/Add"]},
]

HOUSING_PREPROCESSING = {
    "drop_columns": [
        "pool_qc", "mic_feature", "alley", "fence", "misc_val", "mo_sold", "lot_frontage",
        "ms_subclass",
    ],
    "fillna": {
        "numerical_zero": [
            "bsmtfin_sf_1", "bsmtfin_sf_2", "bsmt_unf_sf", "total_bsmt_sf", "bsmt_full_bath",
            "bsmt_half_bath", "mas_vnr_area", "garage_yr_blt",
        ],
        "categorical_none": [
            "bsmt_qual", "bsmt_cond", "bsmt_exposure", "bsmtfin_type_1", "bsmtfin_type_2",
            "mas_vnr_type", "garage_type", "garage_finish", "garage_qual", "garage_cond",
            "fireplace_qu",
        ],
    },
    "dropna_rows": ["electrical", "garage_cars"],
    "encoding": {"one_hot": {"apply_to": "categorical", "drop": "first", "handle_unknown": "ignore", "null_category": True}},
    "scaling": {"method": "standard", "apply_to": ["continuous", "ordinal"]},
}


def housing_config(raw_path: str = "data/raw/housing.csv") -> dict:
    """The reference's pipeline settings for its housing table.

    The rename map is the rule "lower case, spaces and slashes to ``_``" over
    the declared columns; the ``TotRms AbvGrd`` column (``TotRms AbvGr`` in scoring records)
    is mapped to the name the feature lists use, ``totrms_abvgr``.
    """
    raw_columns = HOUSING_INT_COLUMNS + HOUSING_FLOAT_COLUMNS + HOUSING_STR_COLUMNS
    rename = {c: snake_name(c) for c in raw_columns}
    rename["TotRms AbvGrd"] = rename["TotRms AbvGr"] = "totrms_abvgr"
    declared = ([{"name": c, "dtype": "int", "required": True} for c in HOUSING_INT_COLUMNS]
                + [{"name": c, "dtype": "float", "required": True} for c in HOUSING_FLOAT_COLUMNS]
                + [{"name": c, "dtype": "str", "required": True} for c in HOUSING_STR_COLUMNS])
    pre = dict(HOUSING_PREPROCESSING)
    pre["rename_columns"] = rename
    return {
        "key": "pid",
        "target": "saleprice",
        "data_source": {"raw_path": raw_path, "type": "csv", "delimiter": ",", "header": 0,
                        "encoding": "utf-8"},
        "data_split": {"train": 0.6, "valid": 0.2, "test": 0.2, "random_state": 42},
        "model": {"active": "linear_regression"},
        "selection": {"k": 10},
        "metrics": ["MSE", "RMSE", "MAE", "r2"],
        "features": HOUSING_FEATURES,
        "engineering": HOUSING_ENGINEERING,
        "preprocessing": pre,
        "data_validation": {"enabled": True, "action_on_error": "raise",
                            "schema": {"columns": declared}},
    }


def housing_record_contract(key: str | None = None) -> list[dict]:
    """Scoring-record contract: 16 required and 55 optional typed fields.

    ``key`` names one more, optional int field, by which predictions are matched to records.
    """
    return ([{"name": n, "dtype": t, "required": True} for n, t in HOUSING_RECORD_REQUIRED.items()]
            + [{"name": n, "dtype": t, "required": False} for n, t in HOUSING_RECORD_OPTIONAL.items()]
            + ([{"name": key, "dtype": "int", "required": False}] if key else []))
